"""Hashed counters over all rows: a table of a fixed number of cells, each with the number of hashes that fall into it.

Every task counts its own hashes and hands its cells on in compressed chunks; chunks of one place are added where they meet, one after
the other, so memory is a task's share of the cells whatever the input. Only the finished table, of a size that is fixed by
``cells``, reaches the driver. A count is never less than the true one (other hashes may share the cell) unless it is ``cap``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 16
SLICE = 1 << 20


def kind(cap: int) -> type:
    return np.uint8 if cap < 1 << 8 else np.uint16 if cap < 1 << 16 else np.uint32


def count_into(counts: np.ndarray, hashes: np.ndarray, cap: int) -> None:
    """Add unsigned 64-bit hashes to a table of a power of two of cells."""
    mask = np.uint64(len(counts) - 1)
    for at in range(0, len(hashes), SLICE):
        cells, n = np.unique((hashes[at : at + SLICE] & mask).astype(np.uint32), return_counts=True)
        counts[cells] = np.minimum(counts[cells].astype(np.int64) + n, cap)


def tally(
    docs: DataFrame,
    hashes_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]],
    cells: int,
    cap: int,
    finish: Callable[[np.ndarray], np.ndarray],
) -> np.ndarray:
    """``finish`` of the capped counts of all hashes of all batches; it maps a chunk of counts to an array of at most CHUNK bytes."""
    size = min(CHUNK, cells)

    def count(batches):
        counts = None
        for batch in batches:
            for hashes in hashes_of(batch):
                counts = np.zeros(cells, kind(cap)) if counts is None else counts
                count_into(counts, hashes, cap)
        if counts is not None:
            for at in range(0, cells, size):
                part = counts[at : at + size]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([at // size], pa.int32()), pa.array([zlib.compress(part, 1)])], ["chunk", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                values = np.frombuffer(zlib.decompress(part), kind(cap)).astype(np.int64)
                sums[chunk] = np.minimum(sums.get(chunk, 0) + values, cap)
        for chunk, values in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([finish(values).tobytes()])], ["chunk", "counts"])

    schema = "chunk int, counts binary"
    rows = docs.mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).collect()  # the cells, finished
    empty = finish(np.zeros(size, np.int64))
    out = np.tile(empty, cells // size)
    for r in rows:
        out[r["chunk"] * len(empty) : (r["chunk"] + 1) * len(empty)] = np.frombuffer(r["counts"], empty.dtype)
    return out


def bits(docs: DataFrame, hashes_of, cells: int, least: int) -> np.ndarray:
    """A bit per cell: whether ``least`` or more hashes fall into it."""
    return tally(docs, hashes_of, cells, least, lambda n: np.packbits(n >= least))


def marked(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the cells of unsigned 64-bit hashes are set in ``bits``."""
    at = (hashes & np.uint64(8 * len(found) - 1)).astype(np.int64)
    return (found[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
