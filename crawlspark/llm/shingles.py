"""Near-duplicates by the Jaccard similarity of their sets of five-word shingles, at least 0.8, without loss.

The documents' SimHash fingerprints come first: those that are equal or, by the trees of ``simhash``, at most DISTANCE bits apart give
candidates, which are links if their sets have the similarity. Fingerprints miss some similar sets; those are found by the sets themselves.

Put every set in one common order. Two sets of similarity t share a shingle among the first n - ceil(t n) + 1 of each
(prefix filter), so only documents that meet in such a shingle are candidates, and their whole sets are then compared.
The order is rare first, by a table of hashed counters over all documents (``tally``), then by hash; the result is exact for
any order, and what few documents share stays rare however large the corpus is. At the first shingle that two sets share, all they share lies behind it, so its places in both bound the
similarity. Sizes, these places and the sets' parity bits (one of at least n bits flips for each shingle, so sets
differ in no fewer shingles than bits) rule out pairs before their sets are read.

A group of m near copies has m * m pairs. So each list of a shingle is first cut by a min-hash of its sets, and every set is compared with
one centre of its part only; ROUNDS different min-hashes follow each other, each over what the ones before left in
different components. Only pairs of still different components that share a prefix shingle are compared after that. Centres are found by
map-side combined group-bys, so a shingle that a third of all documents hold is never one task's list.

Shingles are 64-bit hashes and equal sets have one key, a hash of the set. Defined cases: null, empty and blank texts are the
empty set, equal to each other; a text of fewer words than a shingle is one shingle; words are those of ``simhash``; null and repeated
doc_ids are only carried along, equal rows have equal keys; ``simhash.deduplicate`` settles ties and keeps columns of any name apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm import simhash
from crawlspark.llm.common import passing, rows_of, saved
from crawlspark.llm.components import components
from crawlspark.llm.repeats import release
from crawlspark.llm.simhash import LOWER, SEED, least_ids
from crawlspark.llm.tally import bits, marked, tally

#: the similarity is NUMERATOR / DENOMINATOR or more
SHINGLE, NUMERATOR, DENOMINATOR = 5, 4, 5
#: cells of the table of shared prefix shingles; where it fills up, rows are only ruled out later
SEEN = 1 << 25
#: hashed counters, their largest value; words kept per task; rounds of comparing with centres
CELLS, CAP, CACHED, ROUNDS = 1 << 24, (1 << 16) - 1, 100_000, 3
ODD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Hashes of words; emptied when full, which costs time and changes nothing."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= CACHED:
            self.clear()
        found = xxh64_intdigest(word, SEED)
        if len(word) <= 64:
            self[word] = found
        return found


def shingle_set(text: str | None, words: Words) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(SHINGLE, len(found))
    out = np.full(len(found) - size + 1, size, np.uint64)
    for i in range(size):
        out = (out ^ codes[i : i + len(out)]) * ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


def key_of(tokens: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(tokens.tobytes(), SEED)


def parity(tokens: np.ndarray) -> bytes:
    """Parities of the number of shingles at each of a power of two of places, at least as many as shingles."""
    size = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    at = (tokens >> np.uint64(20)) & np.uint64(size - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=size) & 1).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """No more than the number of shingles that one of two sets has, by their parity bits."""
    x, y = (np.frombuffer(v, np.uint8) for v in (x, y))
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def sets_of(batch: pa.RecordBatch):
    """(first row, sets) of slices of a batch."""
    words = Words()
    for start, texts in rows_of(batch, "text"):
        yield start, [shingle_set(t, words) for t in texts]


def signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (text and any narrow columns) without the text, with fp, the key of its set, n and bits, its size and parities, and sim, the text's fingerprint; keys are signed longs."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "fp bigint, n int, bits binary, sim bigint"])

    def run(batches):
        for batch in batches:
            found = [(key_of(s), len(s), parity(s)) for _, sets in sets_of(batch) for s in sets]
            keys, sizes, bits = zip(*found) if found else ((), (), ())
            prints = [simhash.fingerprint(t) for _, texts in rows_of(batch, "text") for t in texts]
            columns = [signed(keys), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()), signed(prints)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *columns], [*kept, "fp", "n", "bits", "sim"])

    return docs.mapInArrow(run, schema)


def ranks(docs: DataFrame) -> np.ndarray:
    """How often shingles occur over all documents: a byte per cell, sixteen steps per doubling of the count."""

    def hashes(batch):
        for _, sets in sets_of(batch):
            yield np.concatenate(sets) if sets else np.zeros(0, np.uint64)

    return tally(docs.select("text"), hashes, CELLS, CAP, lambda n: np.minimum(255, 16 * np.log2(n + 1)).astype(np.uint8))


def prefix(tokens: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first n - ceil(t n) + 1 shingles of a set, rare first."""
    tokens = tokens[np.argsort(often[(tokens & np.uint64(len(often) - 1)).astype(np.int64)], kind="stable")]
    n = len(tokens)
    return tokens[: n - -(-n * NUMERATOR // DENOMINATOR) + 1]


def min_hashes(tokens: np.ndarray) -> int:
    """ROUNDS min-hashes of 16 bits each; they only group sets that are likely similar."""
    found = 0
    for i in range(ROUNDS):
        least = int((tokens * np.uint64(2 * i + 1) * ODD ^ tokens >> np.uint64(7 * i + 3)).min())
        found |= ((least * int(ODD) >> 40) & 0xFFFF) << 16 * i
    return found


def unsigned(column: str):
    return lambda batch: [batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)]


def likely(rows: DataFrame, column: str, found: np.ndarray) -> DataFrame:
    """Rows whose ``column``, a hash, has a cell that is set; what is left out need not be shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(found)  # SEEN bits

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(marked(shared.value, *unsigned(column)(batch))))

    return rows.mapInArrow(run, rows.schema)


def members(docs: DataFrame) -> DataFrame:
    """(token, fp, n, pos, mins) of prefix shingles that different sets share."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks(docs))  # CELLS bytes

    def run(batches):
        for batch in batches:
            for _, sets in sets_of(batch):
                sets = [s for s in sets if len(s)]
                if sets:
                    parts = [prefix(s, shared.value) for s in sets]
                    sizes = [len(p) for p in parts]
                    columns = [
                        signed(np.concatenate(parts)),
                        signed(np.repeat(np.array([key_of(s) for s in sets], np.uint64), sizes)),
                        pa.array(np.repeat([len(s) for s in sets], sizes).astype(np.int32)),
                        pa.array(np.concatenate([np.arange(s) for s in sizes]).astype(np.int32)),
                        signed(np.repeat(np.array([min_hashes(s) for s in sets], np.uint64), sizes)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["token", "fp", "n", "pos", "mins"])

    rows = saved(docs.select("text").mapInArrow(run, "token long, fp long, n int, pos int, mins long"), "shingles-prefixes")
    release(rows)
    # all rows meet once, by token and key alone, so that what is shuffled here follows the input
    shared = rows.groupBy("token").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least <> most")
    shared = saved(shared.select("token"), "shingles-shared")
    release(shared)
    rows = likely(rows, "token", bits(shared, unsigned("token"), SEEN, 1))
    return rows.join(shared, "token", "left_semi").dropDuplicates(["token", "fp"])


def may_reach(n: Column, pos: Column, n2: Column, pos2: Column) -> Column:
    """Whether two sets may be similar, from their sizes and the places of the first shingle that they share."""
    return F.least(n - pos, n2 - pos2) * (NUMERATOR + DENOMINATOR) >= (n + n2) * NUMERATOR


def beside(pairs: DataFrame, values: DataFrame, keep) -> DataFrame:
    """``pairs`` (a, b: keys) for which ``keep`` holds of the values (fp, value) of both."""

    def run(batches):
        for batch in batches:
            kept = []
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                both = zip(part.column("x").to_pylist(), part.column("y").to_pylist())
                kept += [start + i for i, (x, y) in enumerate(both) if keep(x, y)]
            yield batch.take(pa.array(kept, pa.int64())).select(["a", "b"])

    first, second = (values.select(F.col("fp").alias(key), F.col("value").alias(name)) for key, name in (("a", "x"), ("b", "y")))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def may_be_similar(x, y) -> bool:
    n = x["n"] + y["n"]
    return least_difference(x["bits"], y["bits"]) * (NUMERATOR + DENOMINATOR) <= (DENOMINATOR - NUMERATOR) * n


def are_similar(x: bytes, y: bytes) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * DENOMINATOR >= (len(x) + len(y) - both) * NUMERATOR


def sets_by_key(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(fp, value) of the sets of ``keys`` (fp) and perhaps others, their shingles as bytes, copies included; written once for all rounds, not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(bits(keys, unsigned("fp"), SEEN // 8, 1))  # SEEN / 8 bits

    def run(batches):
        for batch in batches:
            for _, sets in sets_of(batch):
                found = np.array([key_of(s) for s in sets], np.uint64)
                kept = np.flatnonzero(marked(shared.value, found))
                kept = kept[np.unique(found[kept], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([signed(found[kept]), pa.array([sets[i].tobytes() for i in kept], pa.binary())], ["fp", "value"])

    return saved(docs.select("text").mapInArrow(run, "fp long, value binary"), "shingles-sets")


def similar(pairs: DataFrame, sets: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b: keys) whose sets have the similarity; only sets of pairs that may have it are shuffled."""
    with passing():
        pairs = saved(beside(pairs, sketches, may_be_similar), "shingles-likely")
        keys = pairs.select(F.col("a").alias("fp")).union(pairs.select("b"))
        needed = likely(sets, "fp", bits(keys, unsigned("fp"), SEEN // 8, 1))
        needed = saved(needed.groupBy("fp").agg(F.first("value").alias("value")), "shingles-compared")
        return saved(beside(pairs, needed, are_similar), "shingles-links", lasting=True)


def by_fingerprints(rows: DataFrame) -> DataFrame:
    """Candidates (a, b: keys): sets of texts whose fingerprints are equal or linked by ``simhash``; ``rows`` are those of ``keyed``.

    Of a fingerprint's sets all are paired with one, and the fingerprints by the links, a spanning forest: no group makes all its pairs.
    """
    prints = saved(rows.where("n > 0").select("sim", "fp").distinct(), "shingles-prints")
    first = saved(prints.groupBy("sim").agg(F.min("fp").alias("key")), "shingles-fingerprints")
    within = prints.join(first, "sim").where("fp <> key").select(F.col("key").alias("a"), F.col("fp").alias("b"))
    linked = simhash.close_pairs(first.select(F.col("sim").alias("fp")))
    x, y = (first.select(F.col("sim").alias(end), F.col("key").alias(name)) for end, name in (("a", "x"), ("b", "y")))
    across = linked.join(x, "a").join(y, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return saved(within.union(across).distinct(), "shingles-near")


def rooted(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` with root, the component of the set by ``links`` so far."""
    linked = components(links).withColumnRenamed("node", "fp")
    return saved(found.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "shingles-rooted")


def close_pairs(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b: keys) whose components are those of all pairs of the similarity; ``rows`` are those of ``keyed``."""
    sketches = saved(rows.groupBy("fp").agg(F.first(F.struct("n", "bits")).alias("value")), "shingles-sketches")
    with passing():
        found = saved(members(docs), "shingles-members", lasting=True)
    release(found)
    tried = by_fingerprints(rows)
    keys = found.select("fp").union(tried.select("a")).union(tried.select("b")).distinct()
    sets = sets_by_key(docs, saved(keys, "shingles-needed"))
    release(sets)
    links = similar(tried, sets, sketches)
    now = rooted(found, links)
    release(now)
    n, pos = F.col("n"), F.col("pos")
    for i in range(ROUNDS):
        part = F.shiftright("mins", 16 * i).bitwiseAND(0xFFFF)
        # the larger sets first have the most to share; any centre will do
        centre = F.max(F.struct((n - pos).alias("room"), "fp", "n", "root")).alias("centre")
        listed = now.withColumn("part", part)
        near = listed.join(listed.groupBy("token", "part").agg(centre), ["token", "part"]).where("root <> centre.root")
        near = near.where(may_reach(n, pos, F.col("centre.n"), F.col("centre.n") - F.col("centre.room")))
        near = near.select(F.least("centre.fp", "fp").alias("a"), F.greatest("centre.fp", "fp").alias("b")).distinct()
        near = saved(near.join(tried, ["a", "b"], "left_anti"), "shingles-near")
        tried = tried.union(near)
        if near.isEmpty():
            continue
        links = links.union(similar(near, sets, sketches))
        now = rooted(found, links)
        release(now)
    # a pair of different components has at least one side outside of the list's largest component
    groups = now.groupBy("token", "root").agg(F.count("*").alias("size")).groupBy("token")
    most = groups.agg(F.max_by("root", F.struct("size", "root")).alias("most"), F.count("*").alias("groups")).where("groups > 1").drop("groups")
    mixed = saved(now.join(most, "token"), "shingles-mixed")
    x, y = mixed.where("root != most").alias("x"), mixed.alias("y")
    pairs = x.join(y, F.col("x.token") == F.col("y.token")).where("x.root != y.root and (y.root = y.most or x.fp < y.fp)")
    pairs = pairs.where(may_reach(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos")))
    pairs = pairs.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")).distinct()
    pairs = saved(pairs.join(tried, ["a", "b"], "left_anti"), "shingles-pairs")
    return links.union(similar(pairs, sets, sketches))


#: rows and bytes that Spark hands to Python at a time, unless the session has less; a row holds a whole text, or two sets
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def classes(docs: DataFrame) -> DataFrame:
    """As ``simhash.classes``, with the fingerprints' links held to the sets, and the similar sets that they miss."""
    conf = docs.sparkSession.conf
    before = {name: conf.get(name) for name in BATCHES}
    for name, most in BATCHES.items():
        set_to = before[name].rstrip("Bb")
        conf.set(name, str(min(most, int(set_to))) if set_to.isdigit() and int(set_to) > 0 else str(most))
    try:
        rows = saved(keyed(docs), "shingles-rows")
        return least_ids(rows.drop("n", "bits", "sim"), lambda distinct: close_pairs(docs, rows))
    finally:
        for name, value in before.items():
            conf.set(name, value)
