"""Packing documents into sequences: Martello-Toth dominance reduction, then best-fit decreasing.

Lengths are integers up to the capacity, so the whole instance is a count per length, at most 2048 numbers
whatever the corpus holds. The reduction and best-fit run on those counts, where a step fixes any number of equal
sequences at once, and yield slots: items of one length with ranks lo, lo+1, ... go to sequences base, base+1, ... at an
offset. The items themselves are numbered within their length in parallel and meet their slot in one join; nothing
that grows with the corpus passes the driver.

Tokens come from tiktoken with the ranks of the byte-level vocabulary, which gives the ids of the tokenizers file (a
test compares them) at four times the speed. The split pattern is the published one written with possessive
quantifiers, which match the same strings.

Defined cases: a null or empty text is the end id alone; equal rows are separate items; an empty table gives no rows;
the string of the added token ``END_OF_TEXT`` in a text is that token, as in the tokenizers file's default settings, if
``end_of_text`` is set (``op7_packing`` and the pipeline), else ordinary text; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import rows_of, saved, table

CAPACITY, END = 2048, 0
VOCABULARY = "byte_bpe_50k.tiktoken"
#: the tokenizers file's added token
END_OF_TEXT, END_OF_TEXT_ID = "<|endoftext|>", 50_256
#: the published split of this vocabulary (fixed value), possessive where that can't change a match
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
PARTS, ITEMS_PER_PART = 256, 50_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(2)
def encoder(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: END_OF_TEXT_ID})


def tokens(path: str, text: str | None, end_of_text: bool = False) -> bytes:
    """Little-endian unsigned 32-bit ids of a text and the end id."""
    ids = encoder(path).encode_to_numpy(text or "", allowed_special={END_OF_TEXT} if end_of_text else set(), disallowed_special=())
    return ids.astype("<u4").tobytes() + END.to_bytes(4, "little")


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be short."""
    start, end = 0, (n - 1) % capacity + 1
    while end <= n:
        yield start, end - start
        start, end = end, end + capacity


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, ids: bool = False, end_of_text: bool = False) -> DataFrame:
    """A row per piece: doc_id, row (tells equal doc_ids apart), piece, start, length, ids_crc32 and, if asked for, its ids."""
    path = path or vocabulary_path()
    schema = "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids

    def run(batches):
        import numpy as np

        for batch in batches:
            for first, texts in rows_of(batch, "text"):
                keys = [batch.column(c).slice(first, len(texts)).to_pylist() for c in ("doc_id", "row")]
                out = []
                for doc, row, text in zip(*keys, texts):
                    data = tokens(path, text, end_of_text)
                    for piece, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                        part = data[4 * start : 4 * (start + length)]
                        one = (doc, row, piece, start, length, zlib.crc32(part))
                        out.append((*one, np.frombuffer(part, "<i4")) if ids else one)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * ids
                names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(run, schema)


class Counts:
    """How many items of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v}
        self.lengths = sorted(self.n)

    def take(self, length: int, times: int) -> None:
        self.n[length] -= times
        if not self.n[length]:
            del self.n[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def largest(self, room: int) -> int:
        """The largest length left that is at most ``room``, or 0."""
        i = bisect_left(self.lengths, room + 1)
        return self.lengths[i - 1] if i else 0

    def smallest(self, k: int, without: int) -> list[int]:
        """The k smallest items left apart from one item of a length."""
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(k - len(out), self.n[length] - (length == without))
            if len(out) == k:
                break
        return out

    def best_pair(self, room: int, without: int) -> int:
        """The largest sum of two items within ``room``, apart from one item of a length."""
        best, i, j = 0, 0, len(self.lengths) - 1
        while i <= j:
            a, b = self.lengths[i], self.lengths[j]
            if a + b > room:
                j -= 1
            elif a == b:
                if self.n[a] - (a == without) >= 2:
                    best = max(best, 2 * a)
                i += 1
            else:
                if self.n[a] - (a == without) >= 1 and self.n[b] - (b == without) >= 1:
                    best = max(best, a + b)
                i += 1
        return best


def dominating(left: Counts, item: int, capacity: int) -> list[int] | None:
    """A set with this item that dominates every other set with it, if the criterion finds one.

    Nothing fits beside the item: the item alone. Otherwise let b be the largest that fits. The pair dominates if it
    fills the sequence, if no two items fit beside the item, or if none of three do and no two weigh more than b.
    """
    room = capacity - item
    left.take(item, 1)
    try:
        partner = left.largest(room)
        if not partner:
            return [item]
        if partner == room:
            return [item, partner]
        low = left.smallest(3, 0)
        if len(low) < 2 or low[0] + low[1] > room:
            return [item, partner]
        if (len(low) < 3 or sum(low) > room) and left.best_pair(room, 0) <= partner:
            return [item, partner]
        return None
    finally:
        if item not in left.n:
            insort(left.lengths, item)
        left.n[item] = left.n.get(item, 0) + 1


def reduce(left: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets, largest items first, until a pass finds none: (set, how many)."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    found = True
    while found:
        found = False
        for item in sorted(left.n, reverse=True):
            while left.n.get(item) and (best := dominating(left, item, capacity)):
                found = True
                if len(best) == 1:
                    times = left.n[item]
                elif best[0] == best[1]:
                    times = left.n[item] // 2
                elif sum(best) == capacity or len(low := left.smallest(2, 0)) < 2 or low[0] + low[1] + item > capacity:
                    # what is left only shrinks, so the reason still holds for the next pairs
                    times = min(left.n[item], left.n[best[1]])
                else:
                    times = 1
                for length in best:
                    left.take(length, times)
                fixed.append((tuple(best), times))
    return fixed


def best_fit(left: Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: (content, how many sequences)."""
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by room left
    rooms: list[int] = []

    def put(room: int, content: tuple[int, ...], times: int) -> None:
        if not open_[room]:
            insort(rooms, room)
        open_[room][content] = open_[room].get(content, 0) + times

    for length in sorted(left.n, reverse=True):
        n = left.n[length]
        while n:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, (length,) * each, n // each)
                if n % each:
                    put(capacity - n % each * length, (length,) * (n % each), 1)
                break
            room = rooms[i]
            content, times = open_[room].popitem()
            if not open_[room]:
                rooms.pop(i)
            each = room // length
            if n >= each:
                used = min(times, n // each)
                put(room - each * length, content + (length,) * each, used)
                n -= used * each
            else:
                used = 1
                put(room - n * length, content + (length,) * n, 1)
                n = 0
            if times > used:
                put(room, content, times - used)
    return [(content, times) for same in open_.values() for content, times in same.items()]


def arrange(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, lo, hi, base, each, offset): the item of that length with rank r in [lo, hi) goes to sequence
    base + (r - lo) // each, at offset + length * ((r - lo) % each)."""
    left = Counts(counts)
    sets = reduce(left, capacity)
    sets += best_fit(left, capacity)
    slots, used, base = [], defaultdict(int), 0
    for content, times in sets:
        offset = 0
        for length in dict.fromkeys(content):
            each = content.count(length)
            slots.append((length, used[length], used[length] + times * each, base, each, offset))
            used[length] += times * each
            offset += each * length
        base += times
    return slots


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (unique doc_id, row, piece; length) with sequence_id and offset.

    Ranks within a length: items are dealt by hash over parts, numbered within (part, length), and shifted by
    the counts of the parts before, so a length that most items share is spread over all parts.
    """
    items = saved(items, "pack-items")
    spark = items.sparkSession
    n = items.count()
    part = F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(max(PARTS, n // ITEMS_PER_PART))).alias("part")
    dealt = items.withColumn("part", part)
    sizes = saved(dealt.groupBy("length", "part").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    slots = spark.createDataFrame(arrange(counts, capacity), "_length long, lo long, hi long, base long, each long, first long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    starts = sizes.select(F.col("length").alias("_l"), F.col("part").alias("_p"), before.alias("before"))
    within = F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "row", "piece")) - 1
    ranked = dealt.withColumn("within", within)
    ranked = ranked.join(starts, (F.col("part") == F.col("_p")) & (F.col("length") == F.col("_l")))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    # slots: a few for each of at most `capacity` lengths, whatever the corpus holds
    placed = ranked.join(
        F.broadcast(slots), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    )
    at = F.col("rank") - F.col("lo")
    return placed.select(
        *items.columns,
        (F.col("base") + F.floor(at / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("first") + F.col("length") * (at % F.col("each"))).cast("bigint").alias("offset"),
    )


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), end_of_text=True)


def packed(docs: DataFrame, end_of_text: bool = False) -> DataFrame:
    out = pack(pieces(docs, end_of_text=end_of_text))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
