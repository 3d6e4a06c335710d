"""The pipeline's near-duplicates against the true Jaccard similarity of five-word shingles."""

import random
import re
from collections import Counter

import corpus_pipeline
import pytest
from test_simhash import TEXTS, plain_components

from crawlspark.llm import shingles, simhash


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(x, y):
    return x == y or 5 * len(x & y) >= 4 * len(x | y)


def plain_links(texts):
    sets = [plain_set(t) for t in texts]
    return {(i, j) for i in range(len(sets)) for j in range(i) if similar(sets[i], sets[j])}


def prose(rng, n, words=5000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def changed(rng, words, times):
    words = list(words)
    for at in rng.sample(range(len(words)), times):
        words[at] = f"new{rng.randrange(10**9)}"
    return words


def rows():
    rng = random.Random(5)
    texts = []
    for n, times in [(100, 1), (100, 2), (300, 1), (300, 3), (300, 6), (300, 7), (300, 9)] * 12:  # true similarity from 0.97 to 0.74
        words = prose(rng, n)
        texts += [" ".join(words), " ".join(changed(rng, words, times)).upper()]
    base, passage = prose(rng, 200), prose(rng, 60)
    texts += [" ".join(changed(rng, base, rng.randint(1, 4))) for _ in range(120)]  # a large group, not all pairs of it similar
    texts += [" ".join(prose(rng, rng.randint(5, 40)) + passage + prose(rng, rng.randint(5, 40))) for _ in range(80)]
    texts += [" ".join(prose(rng, rng.randint(1, 30), 2)) for _ in range(60)]  # few words, equal sets of different texts
    step = prose(rng, 150)
    for _ in range(15):  # a chain: neighbours are similar, its ends are not
        step = changed(rng, step, 2)
        texts.append(" ".join(step))
    texts += [texts[0]] * 30 + TEXTS
    return [(i, t, "clash") for i, t in enumerate(texts)]


@pytest.mark.parametrize("cells, rounds", [(1 << 20, 4), (64, 1)])
def test_stage_by_true_similarity(spark, monkeypatch, cells, rounds):
    monkeypatch.setattr(shingles, "CELLS", cells)  # few cells: any order is exact
    monkeypatch.setattr(shingles, "ROUNDS", rounds)
    found = rows()
    texts = [t for _, t, _ in found]
    root = plain_components(range(len(texts)), plain_links(texts))
    docs = spark.createDataFrame(found, "doc_id long, text string, token string").repartition(4)
    kept = corpus_pipeline.deduplicated(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root.values()))


def test_planted_copies_go(spark):
    rng = random.Random(8)
    texts = []
    for n, times in [(100, 1), (300, 3), (300, 6), (300, 1)] * 25:
        words = prose(rng, n)
        texts += [" ".join(words), " ".join(changed(rng, words, times))]
    assert all(similar(plain_set(texts[i]), plain_set(texts[i + 1])) for i in range(0, len(texts), 2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.deduplicated(spark, docs, "").collect()}
    assert kept == set(range(0, len(texts), 2))
    assert simhash.deduplicate(docs).count() > len(kept)  # op9's fingerprints miss some, as its contract says


def test_equal_rows_nulls_and_empty_table(spark):
    words = " ".join(map(str, range(50)))
    docs = spark.createDataFrame([(1, words), (1, words), (None, words), (None, None), (2, ""), (3, "alone")], "doc_id long, text string")
    kept = corpus_pipeline.deduplicated(spark, docs, "").collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == {(1, words): 1, (2, ""): 1, (3, "alone"): 1}
    assert corpus_pipeline.deduplicated(spark, docs.limit(0), "").count() == 0


def test_parity_bits_never_exceed_the_difference():
    rng, words = random.Random(3), shingles.Words()
    for _ in range(200):
        one = prose(rng, rng.randint(1, 700), 300)
        two = changed(rng, one, rng.randint(0, len(one))) + prose(rng, rng.randint(0, 200))
        x, y = (shingles.shingle_set(" ".join(w), words) for w in (one, two))
        assert shingles.least_difference(shingles.parity(x), shingles.parity(y)) <= len(set(x.tolist()) ^ set(y.tolist()))


def test_fingerprints_alone_find_links(spark, monkeypatch):
    """Links of the named method: fingerprints linked by the trees, then held to the sets; here nothing else finds any."""
    members = shingles.members
    monkeypatch.setattr(shingles, "members", lambda docs: members(docs).where("false"))
    rng = random.Random(12)
    texts = []
    for _ in range(40):
        words = prose(rng, 400)
        texts += [" ".join(words), " ".join(changed(rng, words, 1))]
    words = prose(rng, 30, 3)
    texts += [" ".join(words), " ".join(words[1:] + words[:1])]  # equal or close fingerprints alone are no link
    near = {i for i in range(0, len(texts), 2) if (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[i + 1])).bit_count() <= 4}
    want = {i + 1 for i in near if similar(plain_set(texts[i]), plain_set(texts[i + 1]))}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.deduplicated(spark, docs, "").collect()}
    assert len(want) > 5 and kept == set(range(len(texts))) - want


def test_work_folders_go_when_they_are_read(spark):
    """Of a deduplication only its kept keys stay, of a strip only its spans; op9's rows, which its result still reads, stay."""
    from pathlib import Path

    from crawlspark.llm import repeats
    from crawlspark.session import work_dir

    base = Path(work_dir(spark, "x")).parent
    docs = spark.createDataFrame([(i, " ".join(f"w{i % 3}x{j}" for j in range(80))) for i in range(9)], "doc_id long, text string")
    left = lambda before: sorted(p.name.rsplit("-", 1)[0] for p in base.iterdir() if p.name not in before)
    before = {p.name for p in base.iterdir()} if base.exists() else set()
    assert simhash.deduplicate(docs, shingles.classes).count() == 3
    assert left(before) == ["simhash-kept"]
    before = {p.name for p in base.iterdir()}
    assert repeats.strip(docs).where("text <> ''").count() == 0
    assert left(before) == ["repeats-spans"]
    before = {p.name for p in base.iterdir()}
    assert simhash.classes(docs).select("root").distinct().count() >= 1
    assert left(before) == ["simhash-rooted", "simhash-rows"]
