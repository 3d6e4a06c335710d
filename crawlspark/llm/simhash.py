"""SimHash near-duplicates: fingerprints of word shingles, linked by vantage-point trees over Hamming distance.

A tree node has a vantage point and a radius; points go inside or outside by their distance to the vantage. A pair
within r of each other is split by a node only if the inner point lies within r of the border (triangle inequality), so
only such points also visit the other side, as queries. The upper levels of the trees are built on a bounded sample and
cut the fingerprints into shards; each shard goes on splitting its own points in the same way and compares what is
left in blocks. That is exact: no pair within the distance is missed, whatever the sample holds.

On 64 random bits the bounds prune little, so there is a tree per block of 16 bits: two fingerprints that differ in at
most 4 bits differ in at most one bit of some block, and there the bound is 1. Where points agree on the whole block, a
shard goes on with all 64 bits and the full distance.

Equal fingerprints are compared once. A shard returns a spanning forest of its links, never all pairs of a group.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other; a text of fewer words
than a shingle is one shingle; a null doc_id counts as larger than any other; equal rows get equal results; an
empty table gives no rows; other columns are not read (``deduplicate`` keeps them all).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import passing, rows_of, saved, table
from crawlspark.llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
BLOCKS = 4
#: about so many fingerprints, chosen by hash, build the upper levels; points in a shard; points compared directly
SAMPLE, SHARD, LEAF = 50_000, 20_000, 96
MOST_SHARDS = 4096
FULL = np.uint64(2**64 - 1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits that more than half of the shingles' XXH64 values have."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle, len(words)) - 1 :]
    values = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[: len(last)].tolist(), last.tolist())]
    set_ = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 14):
        part = np.array(values[at : at + (1 << 14)], "<u8")
        set_ += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(values), bitorder="little").view("<u8")[0])


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (text and any narrow columns) without the text, with fp, the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "fp bigint"])

    def run(batches):
        for batch in batches:
            found = [fingerprint(t) for _, texts in rows_of(batch, "text") for t in texts]
            values = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), values], [*kept, "fp"])

    return docs.mapInArrow(run, schema)


def masks() -> list[np.uint64]:
    width = 64 // BLOCKS
    return [np.uint64(((1 << width) - 1) << (width * i)) for i in range(BLOCKS)]


def distance(a, b, mask):
    return np.bitwise_count((a ^ b) & mask)


def split(points: np.ndarray, mask: np.uint64) -> tuple[np.uint64, int] | None:
    """A vantage point and the radius that cuts the points best in half, or None if all lie at one distance of each candidate."""
    for i in (0, len(points) // 2, len(points) - 1):
        vantage = points[i] & mask
        far = np.bincount(distance(points, vantage, mask), minlength=65).cumsum()
        if far[64] != far[0]:
            inside = far[:-1]
            radius = int(np.abs(inside - len(points) / 2).argmin())
            if 0 < inside[radius] < len(points):
                return vantage, radius
    return None


def upper_tree(sample: np.ndarray, mask: np.uint64, capacity: float) -> list:
    """Nested [vantage, radius, inside, outside], or [] for a shard; ``capacity`` in points of the sample."""
    found = split(sample, mask) if len(sample) > capacity else None
    if found is None:
        return []
    near = distance(sample, found[0], mask) <= found[1]
    return [*found, upper_tree(sample[near], mask, capacity), upper_tree(sample[~near], mask, capacity)]


def route(tree: list, mask: np.uint64, bound: int, points: np.ndarray):
    """Yield (shard path, own points, visiting queries) of an upper tree."""
    stack = [(tree, 1, points, points[:0])]
    while stack:
        node, path, own, guests = stack.pop()
        if not node:
            yield path, own, guests
            continue
        (own_in, guests_in), (own_out, guests_out) = sides(node[0], node[1], mask, bound, own, guests)
        stack += [(node[2], 2 * path, own_in, guests_in), (node[3], 2 * path + 1, own_out, guests_out)]


def sides(vantage, radius: int, mask, bound: int, own: np.ndarray, guests: np.ndarray):
    """Points and queries of the inner and outer side; inner points near the border query the outer side."""
    near, far = distance(own, vantage, mask), distance(guests, vantage, mask)
    inside = near <= radius
    crossing = own[inside & (near > radius - bound)]
    return (own[inside], guests[far <= radius + bound]), (own[~inside], np.concatenate([guests[far > radius - bound], crossing]))


def links(own: np.ndarray, guests: np.ndarray, mask: np.uint64, bound: int, most: int = DISTANCE):
    """All pairs (arrays a, b) of points, and of queries with points, within ``most`` bits of each other."""
    stack = [(own, guests, mask, bound)]
    while stack:
        own, guests, mask, bound = stack.pop()
        if len(own) > LEAF and (found := split(own, mask)):
            for part in sides(*found, mask, bound, own, guests):
                if len(part[0]):
                    stack.append((*part, mask, bound))
        elif len(own) > LEAF and mask != FULL:
            stack.append((own, guests, FULL, most))
        else:
            for at in range(0, len(own), LEAF):
                block = own[at : at + LEAF]
                i, j = np.nonzero(np.triu(distance(block[:, None], block[None, :], FULL) <= most, 1))
                yield block[i], block[j]
                for others in (own[at + LEAF :], guests):
                    for first in range(0, len(others), 1 << 14):
                        part = others[first : first + (1 << 14)]
                        i, j = np.nonzero(distance(block[:, None], part[None, :], FULL) <= most)
                        yield block[i], part[j]


class Forest:
    """Spanning forest of links over values, by union-find with the smaller value as root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def close_pairs(distinct: DataFrame) -> DataFrame:
    """Links (a, b: fingerprints as longs) whose components are those of all pairs within the distance.

    ``distinct`` (fp) holds every fingerprint once.
    """
    n = distinct.count()
    chance = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) / float(1 << 30)
    sample = sorted(r[0] for r in distinct.where(chance < SAMPLE / max(1, n)).collect())
    sample = np.array(sample, np.int64).view(np.uint64)
    shards = min(MOST_SHARDS, -(-n // SHARD))
    forest = [upper_tree(sample, mask, len(sample) / max(1, shards)) for mask in masks()]
    bound = DISTANCE // BLOCKS

    def deal(batches):
        for batch in batches:
            points = batch.column("fp").to_numpy().view(np.uint64)
            for block, (tree, mask) in enumerate(zip(forest, masks())):
                for path, own, guests in route(tree, mask, bound, points):
                    for role, part in ((False, own), (True, guests)):
                        if len(part):
                            full = pa.array(np.full(len(part), block + BLOCKS * path, np.int64))
                            yield pa.RecordBatch.from_arrays([full, pa.array(np.full(len(part), role)), pa.array(part.view(np.int64))], ["shard", "guest", "fp"])

    def compare(key, shard):
        points = shard.column("fp").to_numpy().view(np.uint64)
        guest = shard.column("guest").to_numpy()
        found = Forest()
        for a, b in links(np.unique(points[~guest]), points[guest], masks()[key[0].as_py() % BLOCKS], bound):
            found.add(a, b)
        a, b = np.array(list(found.up), np.uint64).view(np.int64), np.array(list(found.up.values()), np.uint64).view(np.int64)
        return pa.table({"a": a, "b": b})

    dealt = distinct.select("fp").mapInArrow(deal, "shard long, guest boolean, fp long")
    return dealt.groupBy("shard").applyInArrow(compare, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text and any narrow columns): all but the text, with fp, root (a fingerprint
    of the component, the same for all its rows) and component_id, the component's smallest doc_id."""
    return least_ids(saved(fingerprints(docs), "simhash-rows"), close_pairs)


def least_ids(rows: DataFrame, links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` (fp, doc_id and others) with root and component_id, by the links among distinct fp."""
    with passing():
        distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
        linked = components(saved(links_of(distinct), "simhash-links"))
        rooted = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
        rooted = saved(rooted.withColumn("root", F.coalesce("root", "fp")), "simhash-rooted", lasting=True)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.drop("first").join(least, "root"), "fp")


def deduplicate(docs: DataFrame, classes_of: Callable[[DataFrame], DataFrame] = classes) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each component: that of the smallest doc_id, nulls last.

    The text's hash breaks ties between different rows of one doc_id; of equal rows one stays.
    """
    mark = F.struct(F.xxhash64("text"), F.coalesce(F.length("text"), F.lit(-1)))
    narrow = docs.select("doc_id", mark.alias("_mark"), "text")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_mark")
    with passing():
        same = classes_of(narrow).groupBy("root", "doc_id", "_mark").agg(F.count("*").alias("_n"))
        kept = same.groupBy("root").agg(F.min_by(F.struct("doc_id", "_mark", "_n"), order).alias("k"))
        kept = saved(kept.select(F.col("k.doc_id").alias("_id"), F.col("k._mark").alias("_m"), "k._n"), "simhash-kept", lasting=True)
    # a row travels as one column, so that its names meet none of ours
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", mark.alias("_mark"))
    found = marked.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_m")))
    once = found.where("_n > 1").dropDuplicates(["doc_id", "_mark"])
    return found.where("_n = 1").union(once).select("_row.*")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
