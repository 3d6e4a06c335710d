"""Near-duplicate embeddings of equal label by collision-counting projections.

Every vector is projected onto many random lines. Two unit vectors at distance d lie within w of each other on a Gaussian
line with probability 2 Phi(w / d) - 1, independently for each line. So a pair's number of collisions, windows centred on
one of them that hold the other, separates near pairs from far ones: at the threshold's distance it is binomial, and the count
a pair must reach is the largest that a pair at the threshold reaches with probability COUNT_RECALL.

Counting over a whole label would emit a fixed share of all pairs. Vectors are therefore dealt to shards first, in TABLES tables
whose shard numbers are the signs of a few more projections, with as many signs as bring the largest label's shards down to
SHARD vectors, and as many tables as meet TABLE_RECALL at the threshold. Within a shard every line is sorted once, windows are
found by binary search, and collisions are counted for a block of queries at a time. Pairs that reach the count are verified
in double precision. A pair that shares several shards counts in the first table only.

Equal vectors of a label are one point with a weight. No pair leaves its task: a shard returns links per point and a
spanning forest.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link with
nothing and are kept; vectors of different lengths never link; a null vec_id is larger than any other; equal rows link
with each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import saved, table
from crawlspark.llm.components import components

COSINE, SEED = 0.93, 7
LINES, WINDOW = 32, 1.5  # projections that count; half a window in distances of the threshold
COUNT_RECALL, TABLE_RECALL = 0.9995, 0.998
SHARD, CELLS = 1000, 1 << 21


def calibrated(cosine: float, lines: int = LINES, window: float = WINDOW, recall: float = COUNT_RECALL) -> tuple[float, int]:
    """(half window, count to reach) at which pairs at the threshold pass with the given probability."""
    p = math.erf(window / math.sqrt(2))
    tail, count = 0.0, lines + 1
    while tail < recall:
        count -= 1
        tail += math.comb(lines, count) * p**count * (1 - p) ** (lines - count)
    return window * math.sqrt(2 - 2 * cosine), count


def tables_for(cosine: float, signs: int, recall: float = TABLE_RECALL) -> int:
    """Tables after which a pair at the threshold has shared a shard with the given probability."""
    together = (1 - math.acos(cosine) / math.pi) ** signs
    return 1 if signs == 0 else math.ceil(math.log(1 - recall) / math.log(1 - together))


@lru_cache(8)
def lines(dimension: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension, n]).standard_normal((dimension, n))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def shard_numbers(vectors: np.ndarray, signs: int, tables: int) -> np.ndarray:
    """(vectors, tables) numbers made of projection signs."""
    if not signs:
        return np.zeros((len(vectors), 1), np.int64)
    side = (vectors @ lines(vectors.shape[1], signs * tables, SEED + 1) > 0).reshape(len(vectors), tables, signs)
    return side @ (1 << np.arange(signs))


def candidates(vectors: np.ndarray, half: float, count: int):
    """Yield (i, j) arrays of pairs i < j whose windows collide on at least ``count`` lines."""
    n = len(vectors)
    projected = vectors @ lines(vectors.shape[1], LINES, SEED)
    order = np.argsort(projected, axis=0, kind="stable")
    sorted_ = np.take_along_axis(projected, order, 0)
    step = max(1, CELLS // n)
    for first in range(0, n, step):
        queries = projected[first : first + step]
        hits = np.zeros(len(queries) * n, np.int32)
        base = np.arange(len(queries)) * n
        for line in range(LINES):
            low = np.searchsorted(sorted_[:, line], queries[:, line] - half, "left")
            size = np.searchsorted(sorted_[:, line], queries[:, line] + half, "right") - low
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - low, size)
            # a window holds a point once, so plain indexed addition counts right within one line
            hits[order[at, line] + np.repeat(base, size)] += 1
        i, j = np.divmod(np.flatnonzero(hits >= count), n)
        i += first
        yield i[i < j], j[i < j]


def near(vectors: np.ndarray, numbers: np.ndarray, in_table: int, cosine: float):
    """Yield (i, j) of verified pairs of a shard that share no earlier table's shard."""
    half, count = calibrated(cosine)
    for i, j in candidates(vectors, half, count):
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            fine = (vectors[a] * vectors[b]).sum(1) >= cosine
            a, b = a[fine], b[fine]
            first = (numbers[a, :in_table] != numbers[b, :in_table]).all(1)
            yield a[first], b[first]


def usable() -> Column:
    """True for rows that can link; never null."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def linked(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """A row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id (null if all ids are null), kept."""
    rows = vectors.select("vec_id", "embedding", "label")
    # minus zero plus zero is zero
    doubles = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0)
    fine = rows.where(usable()).select("vec_id", "label", doubles.alias("embedding"))
    distinct = fine.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    # a number of its own for each distinct vector; the table is written at once, so it stays the same
    distinct = saved(distinct.withColumn("point", F.monotonically_increasing_id()), "vectors-distinct")
    largest = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs = max(0, math.ceil(math.log2(max(1, largest / SHARD))))
    tables = tables_for(cosine, signs)

    def deal(batches):
        for batch in batches:
            ids = batch.column("point").to_numpy()
            all_ = batch.column("embedding")
            sizes = np.diff(all_.offsets.to_numpy())
            values = all_.values.to_numpy()
            starts = all_.offsets.to_numpy()[:-1]
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                part = unit(values[starts[some][:, None] + np.arange(size)])
                numbers = shard_numbers(part, signs, tables)
                for t in range(tables):
                    out = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays(
                        [out.column("label"), pa.array(np.full(len(some), size, np.int32)), pa.array(np.full(len(some), t, np.int32)), pa.array(numbers[:, t]),
                         pa.array(ids[some]), out.column("copies"), pa.array(list(part), pa.list_(pa.float64())), pa.array(list(numbers), pa.list_(pa.int64()))],
                        ["label", "size", "in_table", "shard", "point", "copies", "vector", "numbers"],
                    )

    def compare(key, shard):
        vectors = np.stack(shard.column("vector").to_numpy())
        numbers = np.stack(shard.column("numbers").to_numpy())
        ids, copies = shard.column("point").to_numpy(), shard.column("copies").to_numpy()
        links = np.zeros(len(ids), np.int64)
        up = np.arange(len(ids))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for a, b in near(vectors, numbers, key[2].as_py(), cosine):
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            # only pairs whose ends are not known to be together yet
            for x, y in zip(a.tolist(), b.tolist()):
                x, y = root(x), root(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
        roots = np.array([root(x) for x in range(len(ids))], np.int64)
        some = (links > 0) | (roots != np.arange(len(ids)))
        return pa.table({"point": ids[some], "other": ids[roots[some]], "links": links[some]})

    kind = vectors.schema["label"].dataType.simpleString()
    dealt = distinct.mapInArrow(
        deal, f"label {kind}, size int, in_table int, shard long, point long, copies long, vector array<double>, numbers array<long>"
    )
    found = saved(dealt.groupBy("label", "size", "in_table", "shard").applyInArrow(compare, "point long, other long, links long"), "vectors-links")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("point").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "point")
    known = distinct.join(links, "point", "left").join(roots, "point", "left")
    known = saved(known.withColumn("root", F.coalesce("root", "point")).withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1), "vectors-known")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(least, "root").select(F.col("label").alias("_l"), F.col("embedding").alias("_e"), "n_links", "component_id")
    member = fine.join(known, (F.col("label") == F.col("_l")) & (F.col("embedding") == F.col("_e"))).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return member.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embeddings(spark, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))
