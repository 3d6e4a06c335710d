"""Packing: ids against the tokenizers library, pieces, gapless placement, and no more sequences than best-fit decreasing."""

import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlspark.llm import packing as P

TEXTS = ["", None, "a", "Hello, world's  end\n\n\tx ", "ä" * 50, "word " * 3000, "<|endoftext|>", "x" * 9000, "  ", "日本語 text 123"]


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def best_fit_decreasing(lengths, capacity):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect_left(rooms, length)
        room = rooms.pop(i) if i < len(rooms) else capacity
        n += room == capacity
        insort(rooms, room - length)
    return n


def check_placement(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_ids_and_pieces(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").withColumn("length", F.lit("clash"))
    rows = P.packed(docs).collect()
    check_placement(rows, 2048)
    for i, text in enumerate(TEXTS):
        ids = reference_ids(text)
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        assert all(r["length"] == 2048 for r in mine[1:]) and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]


def test_equal_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "same text")] * 700 + [(None, "x")], "doc_id long, text string")
    rows = P.packed(docs).collect()
    assert len(rows) == 701 and check_placement(rows, 2048) == -(-sum(r["length"] for r in rows) // 2048)
    assert P.packed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_arrangement(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 2048])
    odd = [1, 2, capacity // 2, capacity // 3 + 1, capacity]
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.choice(odd) for _ in range(rng.choice([0, 1, 3, 20, 200, 2000]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows = []
    for length, lo, hi, base, each, first in P.arrange(dict(counts), capacity):
        rows += [{"sequence_id": base + (r - lo) // each, "offset": first + length * ((r - lo) % each), "length": length, "rank": r} for r in range(lo, hi)]
    assert sorted((r["length"], r["rank"]) for r in rows) == sorted((n, i) for n, k in counts.items() for i in range(k))
    assert -(-sum(lengths) // capacity) <= check_placement(rows, capacity) <= best_fit_decreasing(lengths, capacity)


def brute_bins(lengths, capacity):
    """The least number of sequences, by trying all."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            go(i + 1, rooms[:j] + [rooms[j] - lengths[i]] + rooms[j + 1 :])
        go(i + 1, rooms + [capacity - lengths[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(2, 20) for _ in range(9)]
    left = P.Counts({n: lengths.count(n) for n in set(lengths)})
    fixed = P.reduce(left, 20)
    rest = [n for n, k in left.n.items() for _ in range(k)]
    assert sum(k for _, k in fixed) + brute_bins(rest, 20) == brute_bins(lengths, 20)
