"""Benchmark decontamination: a generalised suffix automaton of the normalised test items, walked by the words of every document.

The automaton accepts every run of consecutive words of any item. A document's words are streamed through it; the state after each word
stands for the longest run of an item that ends there, and its length is tracked. Where that length reaches the window, the last WINDOW words are an
occurrence. Items shorter than a window are whole runs of their own: the state of a short item is met on the suffix links of
the walk's state exactly where the item ends. Hit words are united on the fly, so a text of any length needs memory for its words only.

Items are cut into pieces that overlap by a window less one word, dealt to blocks of at most BLOCK words by a hash, and each block's automaton is built in
a task; a table of arrays of a size bound by BLOCK is what the driver hands on. A benchmark of one block is one pass over the documents, without
a shuffle; more blocks are more passes, each adding its spans and items to what the ones before found.

Defined cases: null, empty and wordless texts have no words and no hits; wordless items never occur; equal rows are counted once each as documents
and once together as items (an item is its item_id, null being the item named by the empty string; the texts of a repeated item_id are all its own);
null and repeated doc_ids are carried along; other columns, whatever their names, are not read (``strip`` keeps them); an empty
benchmark hits nothing, no documents give no rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import rows_of, saved, table

WINDOW = 10
#: most words of a block (its automaton has at most twice as many states), most words of a piece of an item
BLOCK, PIECE = 200_000, 20_000
#: words of a document that are looked at together
STEP = 1 << 16

#: A-Z to a-z, digits, a-z and bytes of other alphabets to themselves, all else to a space
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return (text or "").encode().translate(NORMAL).split()


class Automaton:
    """A generalised suffix automaton over words.

    ``move`` are the transitions of each state by word id, ``link`` the suffix links, ``length`` the longest run of a state. ``window`` of a state
    is the state of its last WINDOW words (-1: shorter), ``whole`` the nearest state on its links, itself included, that is a whole short item
    (-1: none), ``items_of`` the numbers of the items that a window's or a short item's state stands for.
    """

    def __init__(self, pieces: list[tuple[int, bool, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        self.move, self.link, self.length = [{}], [-1], [0]
        ends: list[tuple[int, int, int]] = []
        shorts: dict[int, set[int]] = {}
        for item, short, piece in pieces:
            last = 0
            for i, word in enumerate(piece):
                last = self._extend(last, self.ids.setdefault(word, len(self.ids)))
            if short:
                shorts.setdefault(last, set()).add(item)
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        self.window, self.whole = [-1] * len(order), [-1] * len(order)
        for state in order[1:]:
            up = self.link[state]
            self.whole[state] = state if state in shorts else self.whole[up]
            self.window[state] = self.window[up] if self.length[up] >= window else state if self.length[state] >= window else -1
        self.items_of = shorts
        # the items of a window: walk the pieces again
        for item, short, piece in pieces:
            if not short:
                state = 0
                for i, word in enumerate(piece):
                    state = self.move[state][self.ids[word]]
                    if i >= window - 1:
                        self.items_of.setdefault(self.window[state], set()).add(item)

    def _extend(self, last: int, word: int) -> int:
        """The state of the run that ends in ``last``, one word longer."""
        move, link, length = self.move, self.link, self.length
        there = move[last].get(word)
        if there is not None and length[there] == length[last] + 1:
            return there
        new = None
        if there is None:
            new = len(move)
            move.append({})
            link.append(0)
            length.append(length[last] + 1)
        at = last
        while at != -1 and word not in move[at]:
            move[at][word] = new
            at = link[at]
        if at == -1:
            return new
        there = move[at][word]
        if length[there] != length[at] + 1:
            copy = len(move)
            move.append(dict(move[there]))
            link.append(link[there])
            length.append(length[at] + 1)
            while at != -1 and move[at].get(word) == there:
                move[at][word] = copy
                at = link[at]
            link[there] = copy
            there = copy
        if new is None:
            return there
        link[new] = there
        return new

    def found(self, document: list[bytes], window: int) -> tuple[list[tuple[int, int]], set[int]]:
        """(maximal hit spans of words, states of windows and whole short items that occur)."""
        move, link, length, windows, whole = self.move, self.link, self.length, self.window, self.whole
        ids, shorts = self.ids.get, bool(self.items_of)
        spans: list[tuple[int, int]] = []
        met: set[int] = set()
        state = matched = 0
        if not shorts:
            return spans, met
        for start in range(0, len(document), STEP):
            for i, word in enumerate(map(ids, document[start : start + STEP]), start + 1):
                if word is None:
                    state = matched = 0
                    continue
                there = move[state].get(word)
                if there is None:
                    state = link[state]
                    while state != -1 and word not in move[state]:
                        state = link[state]
                    if state == -1:
                        state = matched = 0
                        continue
                    matched = length[state] + 1
                    state = move[state][word]
                else:
                    state = there
                    matched += 1
                longest = 0
                if matched >= window:
                    # a longer run's earlier words are hit already
                    longest = window
                    met.add(windows[state])
                if (short := whole[state]) != -1:
                    if short == state and matched < length[state]:
                        short = whole[link[state]]
                    while short != -1:
                        longest = max(longest, length[short])
                        met.add(short)
                        short = whole[link[short]]
                if longest:
                    first = i - longest
                    while spans and first <= spans[-1][1]:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i))
        return spans, met


def pieces(benchmark: DataFrame, window: int, piece: int) -> DataFrame:
    """(item, part, short, text, n) of the distinct items' pieces: words joined by spaces, n of them."""

    def run(batches):
        for batch in batches:
            for start, texts in rows_of(batch, "text", 64):
                items = batch.column("item").slice(start, len(texts)).to_pylist()
                for item, text in zip(items, texts):
                    found = words(text)
                    step = piece - window + 1
                    firsts = range(0, max(1, len(found) - window + 1), step) if found else ()
                    out = [found[i : i + piece] for i in firsts]
                    columns = [
                        pa.array([item] * len(out), pa.string()),
                        pa.array(list(range(len(out))), pa.int32()),
                        pa.array([len(found) < window] * len(out), pa.bool_()),
                        pa.array([b" ".join(p) for p in out], pa.binary()),
                        pa.array([len(p) for p in out], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["item", "part", "short", "text", "n"])

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return named.mapInArrow(run, "item string, part int, short boolean, text binary, n bigint").distinct()


def automata(benchmark: DataFrame, window: int, block: int, piece: int) -> DataFrame:
    """(block, automaton): pickled blocks of at most ``block`` words, but for a single piece that has more."""
    parts = saved(pieces(benchmark, window, piece), "leaks-pieces")
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block))
    while True:
        dealt = parts.withColumn("block", F.pmod(F.xxhash64("item", "part", "text"), F.lit(blocks)).cast("int"))
        most = dealt.groupBy("block").agg(F.sum("n").alias("n"), F.count("*").alias("pieces"))
        if most.where((F.col("n") > block) & (F.col("pieces") > 1)).isEmpty():
            break
        blocks *= 2

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("item", "ascending"), ("part", "ascending"), ("text", "ascending")])
        items = rows.column("item").to_pylist()
        names = list(dict.fromkeys(items))
        number = {name: i for i, name in enumerate(names)}
        made = Automaton(
            [(number[i], short, text.split(b" ")) for i, short, text in zip(items, rows.column("short").to_pylist(), rows.column("text").to_pylist())],
            window,
        )
        return pa.table({"block": rows.column("block").slice(0, 1), "automaton": pa.array([pickle.dumps((made, names))], pa.binary())})

    return saved(dealt.groupBy("block").applyInArrow(build, "block int, automaton binary"), "leaks-automata")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """``docs`` (text and any columns) with spans, the maximal hit spans of words as first and end in one long, items, the names of the items
    of which a window occurs, and words, the number of words. Columns of these names are in the way."""
    made = automata(benchmark, window, block, max(piece, 2 * window))
    blocks = sorted(r[0] for r in made.select("block").collect())
    if not blocks:
        spans = F.array().cast("array<bigint>").alias("spans")
        docs = docs.select("*", spans, F.array().cast("array<string>").alias("items"), F.lit(0).cast("bigint").alias("words"))
        return _walk(docs, None, window)
    for i, number in enumerate(blocks):
        one = made.where(F.col("block") == number).first()["automaton"]
        shared = docs.sparkSession.sparkContext.broadcast(one)  # bound by ``block``
        if i == 0:
            docs = docs.select("*", F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items"), F.lit(0).cast("bigint").alias("words"))
        else:
            docs = saved(docs, "leaks-pass")
        docs = _walk(docs, shared, window)
    return docs


def _walk(docs: DataFrame, shared, window: int) -> DataFrame:
    kept = [c for c in docs.columns if c not in ("spans", "items", "words")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        made, names = pickle.loads(shared.value) if shared else (None, [])
        for batch in batches:
            for start, texts in rows_of(batch, "text", 256):
                part = batch.slice(start, len(texts))
                out = []
                for text, spans, items in zip(texts, part.column("spans").to_pylist(), part.column("items").to_pylist()):
                    found = words(text)
                    if made:
                        new, met = made.found(found, window)
                        spans = united([(s >> 32, s & 0xFFFFFFFF) for s in spans] + new) if spans else new
                        spans = [a << 32 | b for a, b in spans]
                        of = made.items_of
                        items = sorted({*items, *(names[i] for state in met for i in of[state])}, key=str.encode)
                    out.append((spans, items, len(found)))
                spans, items, n = zip(*out)
                new = [pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([*map(part.column, kept), *new], [*kept, "spans", "items", "words"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "spans array<bigint>, items array<string>, words bigint"])
    return docs.select(*[F.col(f"`{c}`") for c in kept], "spans", "items", "words").mapInArrow(run, schema)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal spans of the union."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def strip(docs: DataFrame, benchmark: DataFrame, longest: int = WINDOW, coverage: float = 0.8, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) without the spans of hit words of at least ``longest`` words; documents with a larger share than ``coverage`` of hit
    words go as a whole. What is between words goes with the word before it. n_chars, if there is one, is counted anew."""
    # a row travels as one column, so that its names meet none of ours
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = hits(docs.select(row.alias("row"), F.col("text")), benchmark, window)
    counted = "n_chars" in docs.columns

    def run(batches):
        for batch in batches:
            for start, texts in rows_of(batch, "text", 256):
                part = batch.slice(start, len(texts))
                kept, new = [], []
                for i, (text, spans, n) in enumerate(zip(texts, part.column("spans").to_pylist(), part.column("words").to_pylist())):
                    spans = [(s >> 32, s & 0xFFFFFFFF) for s in spans]
                    if sum(b - a for a, b in spans) > coverage * n:
                        continue
                    spans = [(a, b) for a, b in spans if b - a >= longest]
                    kept.append(i)
                    new.append(_without(text, spans) if spans else text)
                sizes = [None if t is None else len(t) for t in new]
                rows = part.column("row").take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([rows, pa.array(new, pa.string()), pa.array(sizes, pa.int64())], ["row", "text", "n"])

    out = found.mapInArrow(run, f"row {found.schema['row'].dataType.simpleString()}, text string, n bigint")
    fresh = {"text": F.col("text")} | ({"n_chars": F.col("n").cast(docs.schema["n_chars"].dataType)} if counted else {})
    return out.select(*[fresh[c].alias(c) if c in fresh else F.col(f"row.`{c}`") for c in docs.columns])


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    data = text.encode()
    word = np.frombuffer(data.translate(NORMAL), np.uint8) != 32
    starts = np.flatnonzero(np.diff(np.concatenate([[False], word]).view(np.int8)) == 1)
    starts = np.append(starts, len(data))
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at : starts[a]])
        at = starts[b]
    return (b"".join(kept) + data[at:]).decode()


def op13_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s.bitwiseAND(0xFFFFFFFF) - F.shiftright(s, 32)))
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        F.expr("size(spans) > 0").alias("contaminated"),
    )


OP13_SQL = r"""
with d as (select row_number() over () as row_, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select distinct coalesce(cast(item_id as varchar), '') as item,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (select distinct item, least(len(w), 10) as n,
                   unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i : i + 9], ' '))) as run
            from b where len(w) > 0),
sizes as (select distinct n from windows),
places as (select row_, n, unnest(range(1, len(w) - n + 2)) as i, w from d, sizes where len(w) >= n),
met as (select p.row_, p.i, p.n, windows.item
        from (select row_, n, i, array_to_string(w[i : i + n - 1], ' ') as run from places) p join windows using (n, run)),
hit as (select row_, count(distinct i) as n_hit
        from (select distinct row_, unnest(range(i, i + n)) as i from (select distinct row_, i, n from met) m) u group by row_),
items as (select row_, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
          from (select distinct row_, item from met) m group by row_)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (row_) left join items using (row_)
"""
