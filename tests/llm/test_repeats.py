"""Repeats: suffix order and common prefixes against sorting, windows and removal against brute force, odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from crawlspark.llm import induced as I
from crawlspark.llm import repeats as R


def plain_suffixes(s, limit):
    order = sorted(range(len(s)), key=lambda i: s[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < limit and max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        common.append(k)
    return order, common


def strings(seed):
    rng = random.Random(seed)
    n, kind = rng.choice([1, 2, 5, 20, 60, 200]), seed % 5
    if kind == 0:
        return bytes(rng.choice(b"ab") for _ in range(n))
    if kind == 1:
        return bytes(rng.randrange(250) for _ in range(n))
    if kind == 2:
        return (b"abcabd" * n)[:n] + b"a" * rng.randint(0, 40)
    if kind == 3:
        return b"\0" * n + b"b" + b"\0" * n
    part = bytes(rng.choice(b"abcd") for _ in range(30))
    return b"".join(part[rng.randint(0, 20) : rng.randint(5, 30)] for _ in range(n))


@pytest.mark.parametrize("seed", range(200))
def test_suffix_order(seed):
    rng = random.Random(-seed)
    s, limit, memory = strings(seed) + b"\xfe", rng.choice([5, 17, 10000]), rng.choice([3, 7, 50, 10**6])
    order, common = plain_suffixes(s, limit)
    places, shared = I.suffixes(np.frombuffer(s, np.uint8), limit, memory=memory)
    assert places.tolist() == order and shared.tolist() == common
    wanted = np.array(sorted(rng.sample(range(len(s)), rng.randint(0, len(s)))), np.int64)
    places, shared = I.suffixes(np.frombuffer(s, np.uint8), limit, wanted, memory)
    assert places.tolist() == [i for i in order if i in set(wanted.tolist())]
    for (a, b), k in zip(zip(places, places[1:]), shared[1:]):
        assert s[a : a + k] == s[b : b + k] and (k == limit or s[a + k] != s[b + k])


def test_queue_spills_and_cleans_up(tmp_path, monkeypatch):
    monkeypatch.setattr(I.tempfile, "mkdtemp", lambda prefix: str((tmp_path / "runs").mkdir() or tmp_path / "runs"))
    rng = np.random.default_rng(1)
    words, ranks = rng.integers(0, 30, 1000).astype(np.uint64), rng.permutation(1000)
    with I.TupleQueue(64) as queue:
        for at in range(0, 1000, 90):
            queue.push(words[at : at + 90], ranks[at : at + 90], np.arange(1000)[at : at + 90])
        batches = list(queue.pop())
        assert len(batches) > 1 and list((tmp_path / "runs").iterdir())
    for a, b in zip(batches, batches[1:]):
        assert a["word"][-1] < b["word"][0]
    assert np.concatenate(batches)["place"].tolist() == np.lexsort((ranks, words)).tolist()
    assert not (tmp_path / "runs").exists()


def test_stretches_cover_all_windows(monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 37)
    data = bytes(random.Random(2).choice(b"abc") for _ in range(300)) + b"a" * 100
    found = list(R.stretches(data, 20, 8))
    first, last, owner = (np.concatenate(x) for x in zip(*found))
    assert first[0] == 0 and last[-1] == len(data) - 20 and (first[1:] == last[:-1] + 1).all()
    by_window = {}
    for a, b, h in zip(first, last, owner):
        for s in range(a, b + 1):
            assert by_window.setdefault(data[s : s + 20], h) == h


def brute(rows):
    """The contract's columns, by counting every window."""
    n = R.LENGTH
    seen = Counter(b[i : i + n] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - n + 1))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        covered = np.zeros(len(b) + 1, int)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                covered[i] += 1
                covered[i + n] -= 1
        gone = np.cumsum(covered[:-1]) > 0
        starts = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc_id, len(b), int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(4)

    def words(n):
        return " ".join(rng.choice(["über", "alpha", "bee", "sea", "dé", "日本"]) + str(rng.randrange(500)) for _ in range(n))

    passage, long = words(120), words(900)
    rows = [(i, words(rng.randint(0, 200))) for i in range(12)]
    rows += [(20 + i, words(rng.randint(0, 60)) + passage + words(rng.randint(0, 60))) for i in range(8)]
    for i in range(10):  # near copies
        parts = long.split()
        for _ in range(i):
            parts[rng.randrange(len(parts))] = "changed"
        rows.append((40 + i, " ".join(parts)))
    rows += [(60, "ab" * 600), (61, "x" * 399), (62, "y" * 400), (63, "y" * 400), (64, "z" * 401), (65, ""), (66, None)]
    rows += [(70, passage[:400]), (71, passage[5:404]), (None, long[100:900]), (None, words(100)), (72, "é" * 260)]
    rows += [(80, words(150))] * 2 + [(81, words(150)), (81, words(150))]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_BYTES", 5000)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "clash", "x") for r in rows], "doc_id long, text string, _spans string, owner string")
    got = R.digests(docs.repartition(4))
    assert sorted((tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr) == brute(rows)


def brute_strip(texts):
    """Texts without the words under a sequence of STRIP_WORDS words that occurs twice."""
    n, found = R.STRIP_WORDS, [list(re.finditer(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    seen = Counter(tuple(m[0] for m in ws[i : i + n]) for ws in found for i in range(len(ws) - n + 1))
    out = []
    for text, ws in zip(texts, found):
        gone = set()
        for i in range(len(ws) - n + 1):
            if seen[tuple(m[0] for m in ws[i : i + n])] > 1:
                gone.update(range(i, i + n))
        for i in sorted(gone, reverse=True):  # a removed word takes the space to the next removed one along
            end = ws[i + 1].start() if i + 1 in gone else ws[i].end()
            text = text[: ws[i].start()] + text[end:]
        out.append(text)
    return out


def test_strip(spark):
    rng = random.Random(4)
    rows = corpus()

    def prose(n):
        return " ".join(f"wörd{rng.randrange(3000)}" for _ in range(n))

    for words in range(45, 62):  # passages planted in otherwise different documents
        passage = prose(words)
        rows += [(1000 + words, f"{prose(30)} {passage}\n{prose(rng.randrange(40))}") for _ in range(3)]
        rows += [(2000 + words, passage.replace(" ", "\n  "))]
    rows += [(3000, "same " * 49), (3001, "same " * 50), (3002, "other " * 51)]
    docs = spark.createDataFrame([(*r, i, len(r[1] or "")) for i, r in enumerate(rows)], "doc_id long, text string, number int, n_chars long")
    out = R.strip(docs.repartition(4))
    assert out.columns == docs.columns
    got = [r["text"] for r in sorted(out.collect(), key=lambda r: r["number"])]
    assert got == brute_strip([t for _, t in rows])
    kept = {i: t for (i, _), t in zip(rows, got) if (i or 0) >= 2000}
    assert all(bool(kept[2000 + n].strip()) == (n < 50) for n in range(45, 62)) and kept[3001].strip() and not kept[3002].strip()


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.digests(docs).count() == 0 and R.strip(docs).count() == 0
