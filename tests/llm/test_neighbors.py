"""Embeddings: links, counts and components against brute force; calibration; odd rows."""

import math
import random

import numpy as np
import pytest

from crawlspark.llm import neighbors as N

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def make(seed, n=250, dimension=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            base = np.array(rows[int(rng.integers(0, min(40, len(rows))))][1])
            vector = base + rng.standard_normal(dimension) * rng.choice([0.0, 0.02, 0.05, 0.08, 0.11])
        else:
            vector = rng.standard_normal(dimension)
        rows.append((i, (vector / np.linalg.norm(vector)).astype(np.float32).tolist(), int(rng.integers(0, 2)), "clash"))
    return rows


def brute(rows):
    usable = {}
    for i, v, label, _ in rows:
        v = None if v is None or any(x is None for x in v) else np.array(v, float)
        if v is not None and len(v) and np.isfinite(v).all() and v.any() and label is not None:
            usable[i] = (v / np.linalg.norm(v), label)
    links = {i: set() for i, *_ in rows}
    for a, (v, k) in usable.items():
        for b, (w, m) in usable.items():
            if a != b and k == m and len(v) == len(w) and v @ w >= N.COSINE:
                links[a].add(b)
    least = {i: i for i in links}
    for _ in links:
        least = {i: min([least[i], *(least[j] for j in links[i])]) for i in links}
    return sorted((i, len(links[i]), least[i], least[i] == i) for i in links)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 20)
    monkeypatch.setattr(N, "CELLS", 500)
    rows = make(seed)
    rows += [(500, rows[0][1], rows[0][2], ""), (501, (3 * np.array(rows[0][1])).tolist(), rows[0][2], ""), (502, rows[0][1], 1 - rows[0][2], "")]
    rows += [(600, None, 0, ""), (601, [0.0] * 24, 0, ""), (602, [math.nan] * 24, 0, ""), (603, [1.0, None], 0, ""), (604, [], 0, "")]
    rows += [(605, rows[0][1], None, ""), (606, [math.inf, 1.0], 0, ""), (607, [1.0, 0.0], 0, ""), (608, [2.0, -0.0], 0, ""), (609, [1e-30, 0.0], 0, "")]
    got = N.linked(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_many_copies_and_null_ids(spark):
    rows = [(None, [1.0, 2.0], 1, ""), (None, [5.0, 1.0], 1, "")] + [(i, [1.0, 2.0], 1, "") for i in range(300)]
    got = N.linked(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in got) == sorted(
        [("None", 300, 0, False), ("None", 0, None, True)] + [(str(i), 300, 0, i == 0) for i in range(300)]
    )


def test_empty(spark):
    assert N.linked(spark.createDataFrame([], SCHEMA)).count() == 0


def test_calibration():
    half, count = N.calibrated(0.93)
    rng = np.random.default_rng(3)
    d = math.sqrt(2 - 2 * 0.93)
    collisions = (np.abs(rng.standard_normal((20000, N.LINES)) * d) <= half).sum(1)
    assert (collisions >= count).mean() >= 0.999 and (collisions >= count + 2).mean() < 0.999
    signs = 3
    assert 1 - (1 - (1 - math.acos(0.93) / math.pi) ** signs) ** N.tables_for(0.93, signs) >= N.TABLE_RECALL


def test_collisions_are_counted_right(monkeypatch):
    monkeypatch.setattr(N, "CELLS", 100)
    vectors = N.unit(np.random.default_rng(1).standard_normal((40, 6)))
    projected = vectors @ N.lines(6, N.LINES, N.SEED)
    found = {(int(i), int(j)) for a, b in N.candidates(vectors, 0.7, 18) for i, j in zip(a, b)}
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if (np.abs(projected[i] - projected[j]) <= 0.7).sum() >= 18}
    assert found == want and want
