"""Chat formatting at token level.

Every part of a turn is encoded on its own and reserved ids, which no text can encode to, are spliced in between:

    ### User: text </turn>        the mark and the end are one reserved id each
    ### [role]: text </turn>      for roles without a mark of their own

The loss mask is the running sum of +1 where a wanted part begins and -1 where it ends; a turn's offset is the running
sum of lengths over its conversation. Control strings inside texts and roles are broken up by backslashes, so the
formatted text can be parsed as text, too; ``unescape`` takes them out again.

Turns are encoded where they are read. Only then do the rows of a conversation meet, sorted, as a stream: a conversation
of any length passes through one task batch by batch, as running sums and digests need its turns in order.

Defined cases: null texts and roles are empty; rows of one turn number are ordered by role, then text, null first; a null turn
comes first; rows without conv_id are one conversation; equal rows are turns of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import saved, table
from crawlspark.llm.packing import encoder, vocabulary_path

#: reserved ids, beyond the vocabulary's 50 257
FIRST = 50_257
MARKS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ", "tool": "### Tool: "}
ROLE_ID = {role: FIRST + i for i, role in enumerate(MARKS)}
OPEN, CLOSE, END = FIRST + 4, FIRST + 5, FIRST + 6
STRINGS = {**{ROLE_ID[r]: s for r, s in MARKS.items()}, OPEN: "### [", CLOSE: "]: ", END: " </turn>\n"}
CONTROL = re.compile(r"\\|(?<=#)#|(?<=<)/(?=turn>)|(?<=\]): ")


def escape(text: str) -> str:
    """No ``###``, ``</turn>`` or ``]: `` is left in the text."""
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def encode(text: str, path: str) -> np.ndarray:
    return encoder(path).encode_to_numpy(escape(text), disallowed_special=()).astype(np.int32)


def format_turn(role: str | None, text: str | None, path: str, learned: Sequence[str] = ("assistant",)) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of a turn."""
    role = role or ""
    known = role in ROLE_ID
    head = [np.array([ROLE_ID[role]])] if known else [np.array([OPEN]), encode(role, path), np.array([CLOSE])]
    parts = [*head, encode(text or "", path), np.array([END])]
    ends = np.cumsum([len(p) for p in parts])
    change = np.zeros(ends[-1] + 1, np.int8)
    if role in learned:
        change[ends[-3]] += 1
        change[ends[-2]] -= 1
    return np.concatenate(parts).astype(np.int32), np.cumsum(change)[:-1] > 0


def formatted(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """A row per turn: conv_id, place (from 0), offset (tokens of the conversation before it), ids, loss."""
    path = path or vocabulary_path()

    def encode_rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [format_turn(r, t, path) for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist())]
                ids = pa.array([f[0] for f in found], pa.list_(pa.int32()))
                loss = pa.array([f[1] for f in found], pa.list_(pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids, loss], [*part.schema.names, "ids", "loss"])

    turns = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    schema = "conv_id bigint, turn bigint, role string, text string, ids array<int>, loss array<boolean>"
    coded = turns.mapInArrow(encode_rows, schema)

    def place_rows(batches):
        current, place, offset = (), 0, 0
        for batch in batches:
            places, offsets = [], []
            lengths = np.diff(batch.column("ids").offsets.to_numpy())
            for conv, n in zip(batch.column("conv_id").to_pylist(), lengths.tolist()):
                if current != (conv,):
                    current, place, offset = (conv,), 0, 0
                places.append(place)
                offsets.append(offset)
                place, offset = place + 1, offset + n
            new = [pa.array(places, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *new, batch.column("ids"), batch.column("loss")], ["conv_id", "place", "offset", "ids", "loss"])

    ordered = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.drop("turn", "role", "text").mapInArrow(place_rows, "conv_id bigint, place bigint, offset bigint, ids array<int>, loss array<boolean>")


def parse(ids: np.ndarray, path: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a sequence of ids."""
    ends = np.flatnonzero(ids == END)
    for start, end in zip(np.concatenate([[0], ends[:-1] + 1]), ends):
        turn = ids[start:end]
        if turn[0] == OPEN:
            close = int(np.flatnonzero(turn == CLOSE)[0])
            role, body = plain(turn[1:close], path), turn[close + 1 :]
        else:
            role, body = next(r for r, i in ROLE_ID.items() if i == turn[0]), turn[1:]
        yield role, plain(body, path)


def plain(ids: np.ndarray, path: str) -> str:
    return unescape(encoder(path).decode_bytes(ids.tolist()).decode())


def rendered(ids: np.ndarray, path: str) -> str:
    """The formatted text."""
    out, at = [], 0
    for i in np.flatnonzero(ids >= FIRST):
        out += [encoder(path).decode_bytes(ids[at:i].tolist()).decode(), STRINGS[int(ids[i])]]
        at = i + 1
    return "".join(out) + encoder(path).decode_bytes(ids[at:].tolist()).decode()


def read_back(turns: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of formatted conversations, from their ids and loss masks alone."""
    path = path or vocabulary_path()
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    class Digest:
        def __init__(self, conv):
            self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def add(self, ids: np.ndarray, loss: np.ndarray) -> None:
            for role, text in parse(ids, path):
                self.n += 1
                self.turns.update(f"{role}\n{text}\n".encode())
            learned = plain(ids[loss], path)
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
            self.chars += len(rendered(ids, path))

        def row(self) -> tuple:
            return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    def run(batches):
        names = [f.split()[0] for f in schema.split(", ")]
        kinds = [pa.string() if f.endswith("string") else pa.int64() for f in schema.split(", ")]
        current: Digest | None = None

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            done = []
            for conv, ids, loss in zip(batch.column("conv_id").to_pylist(), batch.column("ids"), batch.column("loss")):
                if current is None or current.conv != conv:
                    done += [current.row()] if current else []
                    current = Digest(conv)
                current.add(ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False))
            if done:
                yield batch_of(done)
        if current:
            yield batch_of([current.row()])

    ordered = turns.select("conv_id", "place", "ids", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.drop("place").mapInArrow(run, schema)


def op4_chat(spark, sf_dir: str) -> DataFrame:
    odd = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return read_back(saved(formatted(turns), "chat"))


def _escaped_length(c: str) -> str:
    return (
        f"(3 * len({c}) - len(replace({c}, '\\', '')) - len(replace({c}, '#', '')) - len(regexp_extract_all({c}, '#+'))"
        f" + (len({c}) - len(replace({c}, '</turn>', ''))) // 7 + (len({c}) - len(replace({c}, ']: ', ''))) // 3)"
    )


OP4_SQL = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f as (
  select *, {_escaped_length("text")} + {len(STRINGS[END])} + case role
    {" ".join(f"when '{r}' then {len(m)}" for r, m in MARKS.items())} else {len(STRINGS[OPEN]) + len(STRINGS[CLOSE])} + {_escaped_length("role")} end as chars
  from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from f group by conv_id
"""
