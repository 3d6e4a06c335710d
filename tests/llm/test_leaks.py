"""Benchmark decontamination against brute force over all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from crawlspark.llm import leaks as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """(words, hit word numbers, item names) per document."""
    windows = {}
    for name, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add("" if name is None else str(name))
    out = []
    for text in docs:
        w, hit, met = plain_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    met |= found
        out.append((len(w), hit, sorted(met, key=str.encode)))
    return out


def corpus(seed, letters):
    rng = random.Random(seed)

    def prose(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(letters) for _ in range(n))

    items = [(i, prose(rng.randint(0, 40))) for i in range(30)] + [(7, prose(15)), (None, prose(12)), (None, None), (50, ""), (51, "... --")]
    items += [(60 + n, prose(n)) for n in range(1, 12)] + [items[3], (80, items[3][1]), (81, items[3][1] + " " + prose(9))]
    docs = [prose(rng.randint(0, 80)) for _ in range(60)]
    for _ in range(60):
        one, two = rng.choice(items)[1] or "", rng.choice(items)[1] or ""
        docs.append(f"{prose(rng.randint(0, 20))} {one.upper()}! {prose(rng.randint(0, 3))} {two} {prose(rng.randint(0, 9))}")
    return docs + [None, "", "  \n..", "x" * 10_000, docs[60], docs[60], prose(30_000)], items


@pytest.mark.parametrize("letters", [["a", "b"], ["a", "b", "c", "Été", "x9", "日本"], [f"w{i}" for i in range(400)]])
@pytest.mark.parametrize("block, piece", [(L.BLOCK, L.PIECE), (60, 25)])
def test_against_brute_force(spark, letters, block, piece):
    docs, items = corpus(len(letters), letters)
    if block < 100:
        docs = docs[:-1]
    rows = [(i if i % 5 else None, t, "clash", i) for i, t in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, item string, block int").repartition(3)
    bench = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, n string")
    found = {r["block"]: r for r in L.hits(frame, bench, block=block, piece=piece).collect()}
    assert len(found) == len(rows)
    for i, (n, hit, names) in enumerate(brute(docs, items)):
        got = found[i]
        spans = [(s >> 32, s & 0xFFFFFFFF) for s in got["spans"]]
        assert got["words"] == n and got["items"] == names, i
        assert {w for a, b in spans for w in range(a, b)} == hit and all(a[1] < b[0] for a, b in zip(spans, spans[1:])), i


def test_query(spark, tmp_path):
    docs, items = corpus(1, ["a", "b", "c", "d"])
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r["doc_id"]: r for r in L.op13_decontaminate(spark, str(tmp_path)).collect()}
    for i, (n, hit, names) in enumerate(brute(docs, items)):
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert tuple(found[i]) == (i, n, len(hit), len(names), digest, bool(hit))


def test_automaton_is_small_and_exact():
    rng = random.Random(2)
    runs = [[b"%d" % rng.randrange(3) for _ in range(rng.randint(1, 30))] for _ in range(20)]
    made = L.Automaton([(i, len(r) < 10, r) for i, r in enumerate(runs)], 10)
    assert len(made.move) <= 2 * sum(map(len, runs)) + 1
    every = {tuple(r[i:j]) for r in runs for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
    accepted, stack = set(), [(0, ())]
    name = {v: k for k, v in made.ids.items()}
    while stack:
        state, run = stack.pop()
        for word, there in made.move[state].items():
            accepted.add((*run, name[word]))
            stack.append((there, (*run, name[word])))
    assert accepted == every


def test_strip(spark):
    leak = " ".join(f"leak{i}" for i in range(14))
    rows = [
        (1, f"one two {leak.title()}, three four" + " and more of it" * 8, 9, "row"),
        (2, leak, 9, "row"),
        (3, " ".join(leak.split()[:9]) + " clean", 9, "row"),
        (None, None, None, None),
        (4, "", 0, "row"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, row string")
    out = L.strip(docs, spark.createDataFrame([(1, leak)], "item_id long, text string"))
    assert out.dtypes == docs.dtypes
    got = {r["doc_id"]: tuple(r)[1:] for r in out.collect()}
    text = "one two three four" + " and more of it" * 8
    assert got == {1: (text, len(text), "row"), 3: (rows[2][1], len(rows[2][1]), "row"), None: (None, None, None), 4: ("", 0, "row")}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert L.hits(docs, bench.where(F.lit(False))).first()["spans"] == []
    assert L.hits(docs, bench).first()["items"] == ["1"]
    assert L.hits(docs.where(F.lit(False)), bench).count() == 0
    assert L.strip(docs.where(F.lit(False)), bench).count() == 0
