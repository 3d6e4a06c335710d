"""The pipeline against brute force: each stage's decisions on what the stage before kept."""

import random
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_packing import check_placement, reference_ids
from test_repeats import brute_strip
from test_shingles import plain_links, plain_set
from test_simhash import plain_components

from crawlspark.llm import mixing
from crawlspark.llm.common import saved

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _mark string, _row string, found int"
WORDS = {
    "en": "the of and to in that was his with for had not but from this have they which one were all there would their".split(),
    "fr": "le la les des une dans est pour que qui sur pas plus par avec sont mais comme tout nous vous être fait cette".split(),
}


def corpus():
    rng = random.Random(9)
    texts = []

    def prose(lang, n):
        return " ".join(rng.choice(WORDS[lang]) + (str(rng.randrange(90)) if rng.random() < 0.3 else "") for _ in range(n))

    passage = prose("en", 110)
    for i in range(90):
        lang = "fr" if i % 3 == 0 else "en"
        texts.append((prose(lang, rng.randint(3, 250)), lang))
    texts += [(prose("en", 40) + " " + passage + " " + prose("en", 40), "en") for _ in range(6)]
    for i in range(20):  # near copies
        words = texts[i][0].split()
        words[rng.randrange(len(words))] = "changed"
        texts.append((" ".join(words), texts[i][1]))
    texts += [texts[5]] * 7 + [("123 456", "en"), ("", "fr"), (None, "en"), ("the and of to", None)]
    rows = [(i, t, lang, rng.choice(["a", "a", "a", "b", None]), len(t or ""), "clash", None, 1) for i, (t, lang) in enumerate(texts)]
    return rows + [rows[3], (3, "another text of the same id, not the same at all", "en", "b", 47, "clash", "x", 2)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, ""), name)
        found[name] = [tuple(r) for r in docs.collect()]
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "_mark", "_row", "found"]

    # documents of letters stay, others go
    assert sorted(map(repr, found["language"])) == sorted(repr(r) for r in rows if any(c.isalpha() for c in r[1] or ""))
    # one row of each group, that of the smallest id
    texts = sorted({r[1] for r in found["language"]})
    root = dict(zip(texts, plain_components(range(len(texts)), plain_links(texts)).values()))
    assert any(plain_set(t) and root[t] != i for i, t in enumerate(texts))
    least = {}
    for r in found["language"]:
        group = root[r[1]]
        least[group] = min(least.get(group, r[0]), r[0])
    assert Counter(root[r[1]] for r in found["simhash"]) == Counter({g: 1 for g in least})
    assert all(r[0] == least[root[r[1]]] for r in found["simhash"]) and set(found["simhash"]) <= set(found["language"])
    # the words that go
    before = sorted(found["simhash"], key=repr)
    stripped = brute_strip([r[1] for r in before])
    want = [(r[0], t, *r[2:4], len(t), *r[5:]) for r, t in zip(before, stripped)]
    assert Counter(found["suffix"]) == Counter(want) and sum(r[4] for r in before) - sum(r[4] for r in want) > 1000
    # what the mix takes
    takes = {(r["doc_id"], r["source"]): 0 for r in mixing.takes(spark.createDataFrame(found["suffix"], SCHEMA)).collect()}
    for r in mixing.takes(spark.createDataFrame(found["suffix"], SCHEMA)).collect():
        takes[r["doc_id"], r["source"]] += r["repeats"]
    assert Counter((r[0], r[3]) for r in found["mixing"]) == Counter({k: n for k, n in takes.items() if n})
    assert set(found["mixing"]) <= set(found["suffix"]) and len(set(takes.values())) > 1
    # all of it is packed
    packed = docs.collect()
    assert sum(r["length"] for r in packed) == sum(len(reference_ids(r[1])) for r in found["mixing"])
    used = check_placement(packed, 2048)
    assert used == -(-sum(r["length"] for r in packed) // 2048)


def test_run_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    docs.write.parquet(str(tmp_path / "some" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "some")).count() > 0
    docs.where(F.lit(False)).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
