"""Language: the forward sums against listing every segmentation, expected counts, held-out accuracy, odd rows."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlspark.llm import language as G

VOCABULARY = G.pieces_at(G.vocabulary_path())
RNG = np.random.default_rng(5)
PROBABILITY = RNG.dirichlet(np.full(len(VOCABULARY.pieces), 0.3), 2).T
PROBABILITY = np.vstack([np.maximum(PROBABILITY, 1e-9), np.full((1, 2), G.UNKNOWN)])


def brute(probability: dict[str, float], word: str) -> float:
    """Log of the sum over all segmentations of a marked word, by listing them."""

    def total(rest: str) -> float:
        if not rest:
            return 1.0
        return sum(probability.get(rest[:k], G.UNKNOWN if k == 1 else 0.0) * total(rest[k:]) for k in range(1, len(rest) + 1))

    return math.log(total(G.MARK + word))


def test_long_pieces_count():
    longest = max(VOCABULARY.pieces, key=len)
    assert len(longest) == VOCABULARY.longest > 10
    words = [longest.lstrip(G.MARK), "x" + longest.lstrip(G.MARK)]
    got = G.forward(VOCABULARY, PROBABILITY, words)
    table = dict(zip(VOCABULARY.pieces, PROBABILITY[:-1, 0]))
    assert got[:, 0] == pytest.approx([brute(table, w) for w in words])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abcdefghijklmnopqrstuvwxyzéß日ж", min_size=1, max_size=9), min_size=1, max_size=8))
def test_forward_sums_all_segmentations(words):
    got = G.forward(VOCABULARY, PROBABILITY, words)
    for j in range(2):
        table = dict(zip(VOCABULARY.pieces, PROBABILITY[:-1, j]))
        assert got[:, j] == pytest.approx([brute(table, w) for w in words])


def test_long_words_keep_their_range():
    word = "the" * 700
    got = G.forward(VOCABULARY, PROBABILITY, [word, "a"])
    assert np.isfinite(got).all() and got[0, 0] < -1000
    assert got[1] == pytest.approx(G.forward(VOCABULARY, PROBABILITY, ["a"])[0])


def test_expected_uses():
    table = dict(zip(VOCABULARY.pieces, PROBABILITY[:-1, 1]))

    def paths(rest):
        if not rest:
            yield 1.0, []
        for k in range(1, len(rest) + 1):
            p = table.get(rest[:k], G.UNKNOWN if k == 1 else 0.0)
            for q, parts in paths(rest[k:]) if p else ():
                yield p * q, [rest[:k], *parts]

    every = list(paths(G.MARK + "theré"))
    total, want = sum(p for p, _ in every), {}
    for p, parts in every:
        for piece in parts:
            want[piece] = want.get(piece, 0) + 3 * p / total
    got = G.expected(VOCABULARY, PROBABILITY, ["theré"], np.array([1]), np.array([3]))
    place = {p: i for i, p in enumerate(VOCABULARY.pieces)}
    assert got[:, 0].sum() == 0 and got.sum() == pytest.approx(sum(want.values()))
    for piece, n in want.items():
        assert got[place.get(piece, -1), 1] == pytest.approx(n)


def rows(spark, extra=()):
    en, fr = "the cat and the dog went to the house with them ", "le chat et le chien sont dans la maison avec eux "
    data = [(i, (en if i % 2 else fr) * (1 + i % 3), "en" if i % 2 else "fr", "clash") for i in range(60)]
    return spark.createDataFrame([*data, *extra], "doc_id long, text string, lang string, score string")


def test_odd_rows(spark):
    docs = rows(spark, [(100, None, "en", "x"), (101, "", None, "x"), (102, "123 -- !", "fr", "x"), (None, "the dog", "en", "x"), (103, "chien " * 30000, None, "x")])
    out = G.identify(docs, G.fit(docs)).toPandas().set_index("doc_id")
    for i in range(60):
        assert out.lang_pred[i] == ("en" if i % 2 else "fr") and out.score[i] > 0.9
    assert list(out.lang_pred[[100, 101, 102, 103]]) == ["und", "und", "und", "fr"] and (out.score[[100, 101, 102]] == 0).all()


def test_nothing_to_learn_from(spark):
    docs = rows(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {tuple(r) for r in G.identify(docs, G.fit(docs)).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert G.identify(docs.limit(0), G.fit(docs.limit(0))).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = G.op8_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.count(), got.where("lang = lang_pred").count()
    assert n > 200 and right >= 0.98 * n
