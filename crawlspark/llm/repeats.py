"""Removal of every byte covered by a string of LENGTH bytes that also starts anywhere else, by suffix order.

1. Every LENGTH-byte window of a text is owned by the k-gram in it with the least hash (the leftmost of equals), so equal
   windows are owned by equal k-grams at equal distances. Consecutive windows of one owner form a stretch. A stretch whose
   owner's k-gram occurs nowhere else holds no repeat; that is decided on (hash, key) rows, without texts.
2. Stretches that are equal as a whole repeat as a whole; they are found by counting (owner, stretch hash).
3. Of owners with different stretches, each distinct stretch goes once, as text, to the shard of its owner. There an external
   induced sort (``induced``) puts the suffixes at its window starts in order; a window repeats if it shares LENGTH
   bytes with a neighbour in that order.
4. Documents meet the union of their windows.

``strip`` does the same with words for bytes: a text becomes the sequence of its words' 64-bit hashes, WORD bytes each, so that LENGTH bytes are
STRIP_WORDS words, and what is removed are words under a sequence of so many words that also starts anywhere else, whatever white space is
between them.

Steps 1 and 2 lose nothing: they only keep windows from the sort that can't have, or surely have, an equal. A passage that a third
of all documents hold has one owner per some 140 bytes; its equal stretches are counted map-side, and its occurrences are
read by a join that splits skewed keys.

Defined cases: null, empty and short texts have nothing to remove; equal rows, and rows with a null or repeated doc_id, are
occurrences of their own (equal rows get equal results); matches never cross documents; texts of any length are
read in blocks of windows; an empty table gives no rows; other columns are not read (``strip`` keeps them).
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import passing, rows_of, saved, table

LENGTH, GRAM = 400, 128
WORD = 8  # bytes of a word's hash
STRIP_WORDS = LENGTH // WORD
CACHED = 200_000  # words whose hashes a task keeps
BLOCK = 1 << 20  # windows of a text that are looked at together
SHARD_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
HIGH = np.uint64(0xFFFFFFFF00000000)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of a published 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = POWERS(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values: of block suffixes and block prefixes."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """Yield arrays (first, last, owner) of the stretches of a text: their window starts and their owner's hash."""
    all_ = np.frombuffer(data, np.uint8)
    for at in range(0, len(data) - length + 1, BLOCK):
        part = all_[at : at + BLOCK + length - 1]
        hashes = gram_hashes(part, gram)
        # the position makes equal hashes of a window distinct, the leftmost first
        least = least_in_windows((hashes & HIGH) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(least)]]) - 1
        yield at + first, at + last, hashes[(least[first] & ~HIGH).astype(np.int64)]


def mark() -> Column:
    """With doc_id, tells documents apart without their texts; rows that agree in both are equal."""
    return F.xxhash64("text")


def plain(text: str | None) -> bytes:
    return (text or "").encode()


WORDS: dict[bytes, bytes] = {}


def word_codes(text: str | None) -> bytes:
    """The hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, WORD bytes each."""
    from xxhash import xxh64_digest

    if len(WORDS) > CACHED:
        WORDS.clear()
    out = []
    for word in (text or "").encode().split():
        code = WORDS.get(word)
        if code is None:
            code = xxh64_digest(word, 42)
            if len(word) <= 64:
                WORDS[word] = code
        out.append(code)
    return b"".join(out)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of a text, in bytes."""
    a = np.frombuffer(data, np.uint8)
    edges = np.diff(np.concatenate([[False], (a != 32) & ((a < 9) | (a > 13)), [False]]).view(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def both(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 32 | last


def occurrences(docs: DataFrame, data_of=plain) -> DataFrame:
    """A row per stretch: doc_id, _mark, at (first and last window start as one long), owner and stretch hash."""

    def run(batches):
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            for start, texts in rows_of(batch, "text", 256):
                out, row = [], []
                for i, text in enumerate(texts):
                    data = data_of(text)
                    for first, last, owner in stretches(data):
                        view = memoryview(data)
                        content = [xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist())]
                        out.append((first, last, owner.view(np.int64), np.array(content, np.uint64).view(np.int64)))
                        row += [start + i] * len(first)
                if out:
                    first, last, owner, content = (np.concatenate(x) for x in zip(*out))
                    keys = [batch.column(c).take(pa.array(row)) for c in ("doc_id", "_mark")]
                    values = [pa.array(both(first, last)), pa.array(owner), pa.array(content)]
                    yield pa.RecordBatch.from_arrays([*keys, *values], ["doc_id", "_mark", "at", "owner", "content"])

    schema = "doc_id bigint, _mark bigint, at bigint, owner bigint, content bigint"
    return docs.select("doc_id", "text", mark().alias("_mark")).mapInArrow(run, schema)


def repeated_in(texts: list[bytes], windows: list[int], length: int = LENGTH, memory: int | None = None) -> list[np.ndarray]:
    """For each text, which of its first ``windows`` windows occur at another place of these texts."""
    from crawlspark.llm import induced

    data = np.frombuffer(b"".join(texts) + b"\xfe", np.uint8)  # a byte that UTF-8 doesn't have ends the last suffix
    begins = np.cumsum([0, *map(len, texts)])
    wanted = np.zeros(len(data), bool)
    for begin, n in zip(begins.tolist(), windows):
        wanted[begin : begin + n] = True
    places, common = induced.suffixes(data, length, np.flatnonzero(wanted), memory or induced.QUEUE_TUPLES)
    equal = common >= length
    again = equal.copy()
    again[:-1] |= equal[1:]
    found = np.zeros(len(data), bool)
    found[places[again]] = True
    return [found[begin : begin + n] for begin, n in zip(begins.tolist(), windows)]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


def spans(docs: DataFrame, data_of=plain) -> DataFrame:
    """Repeated windows of ``docs`` as rows doc_id, _mark, at (first and last window start in ``data_of`` of the text); they may overlap."""
    docs = docs.select("doc_id", "text")
    with passing():
        every = saved(occurrences(docs, data_of), "repeats-stretches")
        # written, so that the join is of two plain shuffles, whose hot owners Spark splits
        twice = saved(every.groupBy("owner").agg(F.count("*").alias("n")).where("n > 1").select("owner"), "repeats-twice")
        release(twice)
        some = saved(every.join(twice, "owner"), "repeats-shared", lasting=True)
    release(some)
    place = F.struct("doc_id", "_mark", "at")
    kinds = saved(some.groupBy("owner", "content").agg(F.count("*").alias("n"), F.min(place).alias("place")), "repeats-kinds")
    columns = ["doc_id", "_mark", "at"]
    whole = some.join(kinds.where("n > 1").select("owner", "content"), ["owner", "content"], "left_semi").select(*columns)

    mixed_owners = saved(kinds.groupBy("owner").agg(F.count("*").alias("kinds")).where("kinds > 1").select("owner"), "repeats-mixed")
    open_ = saved(kinds.join(mixed_owners, "owner").select("owner", (F.col("n") > 1).alias("whole"), "place.*"), "repeats-open")
    release(some)
    size = open_.agg(F.sum(F.col("at").bitwiseAND(0xFFFFFFFF) - F.shiftright("at", 32) + LENGTH)).first()[0] or 0
    texts = _texts(docs, open_, data_of)

    def compare(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        at = rows.column("at").to_numpy()
        first, last = at >> 32, at & 0xFFFFFFFF
        found = repeated_in([t.as_py() for t in rows.column("part")], (last - first + 1).tolist())
        out, row = [], []
        for i, (flags, whole) in enumerate(zip(found, rows.column("whole").to_pylist())):
            if not whole and flags.any():
                a, b = runs(flags)
                out.append(both(a + first[i], b + first[i]))
                row += [i] * len(a)
        if out:
            keys = [rows.column(c).take(pa.array(row)).combine_chunks() for c in ("doc_id", "_mark")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(np.concatenate(out))], columns)

    shards = texts.repartition(max(1, -(-int(size) // SHARD_BYTES)), "owner")
    partly = saved(shards.mapInArrow(compare, "doc_id bigint, _mark bigint, at bigint"), "repeats-partly")
    release(partly)
    return whole.union(partly)


def release(df: DataFrame) -> None:
    """Let the driver drop what it no longer refers to: shuffle files of steps whose results are written go with it."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _with_texts(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents with the list of their key. The lists are hashed, the texts streamed past them, not sorted."""
    right = lists.withColumnsRenamed({"doc_id": "_id", "_mark": "_m"}).hint("shuffle_hash")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_m"))
    return docs.withColumn("_mark", mark()).join(right, same, how).drop("_id", "_m")


def _texts(docs: DataFrame, open_: DataFrame, data_of) -> DataFrame:
    """``open_`` with the bytes of each stretch as ``part``."""
    lists = open_.groupBy("doc_id", "_mark").agg(F.collect_list(F.struct("owner", "whole", "at")).alias("wanted"))

    def run(batches):
        for batch in batches:
            for start, texts in rows_of(batch, "text", 128):
                row, kept, parts = [], [], []
                for i, text in enumerate(texts):
                    data = data_of(text)
                    for w in batch.column("wanted")[start + i].as_py():
                        row.append(start + i)
                        kept.append((w["owner"], w["whole"], w["at"]))
                        parts.append(data[w["at"] >> 32 : (w["at"] & 0xFFFFFFFF) + LENGTH])
                if row:
                    keys = [batch.column(c).take(pa.array(row)) for c in ("doc_id", "_mark")]
                    rest = [pa.array(c, k) for c, k in zip(zip(*kept), (pa.int64(), pa.bool_(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*rest, *keys, pa.array(parts, pa.binary())], ["owner", "whole", "at", "doc_id", "_mark", "part"])

    schema = "owner bigint, whole boolean, at bigint, doc_id bigint, _mark bigint, part binary"
    # equal rows give their stretches twice, but these repeat as a whole anyway
    found = _with_texts(docs, lists, "inner").select("doc_id", "_mark", "text", "wanted")
    return found.mapInArrow(run, schema)


def merged(places: list[int] | None) -> list[tuple[int, int]]:
    """Maximal removed runs (start, end) of a text, from first and last window starts."""
    out: list[tuple[int, int]] = []
    for at in sorted(places or ()):
        first, end = at >> 32, (at & 0xFFFFFFFF) + LENGTH
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def _cut(docs: DataFrame, fields: dict[str, str], one, data_of=plain) -> DataFrame:
    """``docs`` without text, with columns from ``one(text, its bytes, removed runs)``; ``fields`` are their types."""
    with passing():
        found = saved(spans(docs, data_of), "repeats-spans", lasting=True)
    release(found)
    lists = found.groupBy("doc_id", "_mark").agg(F.collect_set("at").alias("_spans"))
    # the other columns travel as one, so that their names meet none of ours
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in fields and c != "text"])
    joined = _with_texts(docs.select("doc_id", "text", row.alias("_row")), lists, "left").select("_row", "text", "_spans")
    schema = ", ".join([f"_row {joined.schema['_row'].dataType.simpleString()}", *(f"`{c}` {k}" for c, k in fields.items())])
    kinds = [{"string": pa.string(), "bigint": pa.int64()}[k] for k in fields.values()]

    def run(batches):
        for batch in batches:
            for start, texts in rows_of(batch, "text", 128):
                places = batch.column("_spans").slice(start, len(texts)).to_pylist()
                out = [one(t, (t or "").encode(), merged(p)) for t, p in zip(texts, places)]
                new = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("_row").slice(start, len(texts)), *new], ["_row", *fields])

    return joined.mapInArrow(run, schema).select("_row.*", *fields)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes."""

    def one(text, data: bytes, removed) -> tuple:
        kept, at = hashlib.sha256(), 0
        for a, b in removed:
            kept.update(data[at:a])
            at = b
        kept.update(data[at:])
        return len(data), sum(b - a for a, b in removed), len(removed), kept.hexdigest()

    fields = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    return _cut(docs.select("doc_id", "text"), fields, one)


def strip(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the words under a sequence of STRIP_WORDS words that also starts anywhere else, same document
    included; n_chars, if there is one, is counted anew. White space around and other words stay as they are; a null text stays null.
    """

    def one(text, data: bytes, removed) -> tuple:
        if removed:
            starts, ends = word_spans(data)
            kept, at = [], 0
            for a, b in removed:
                a, b = -(-a // WORD), b // WORD  # whole words only
                kept.append(data[at : starts[a]])
                at = ends[b - 1]
            text = (b"".join(kept) + data[at:]).decode()
        return (text, None if text is None else len(text)) if counted else (text,)

    counted = "n_chars" in docs.columns
    return _cut(docs, {"text": "string"} | ({"n_chars": "bigint"} if counted else {}), one, word_codes).select(*docs.columns)


def op1_suffix_array(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
