"""Suffix order and common prefixes of a text by external induced sorting.

A level samples the positions where the text turns upward after going down. The stretches between samples are
sorted and named, and the string of names is solved recursively, which gives the order of the sampled suffixes and the
common-prefix values (in bytes, up to a limit) of neighbours. Then every suffix is a tuple: its symbols up to the next
sample, and that sample's rank. Tuples go through a priority queue that keeps sorted runs on disk beyond its memory and
hands them out in order; as they come, each one's common prefix with the one before follows from the symbols or,
where these agree, from the least common-prefix value between the two samples' ranks.

Symbols that agree as far as one stretch goes while the other goes on: the shorter is the larger, since it turns upward
there and the other goes on downward. So stretches are padded with ones, larger than any symbol.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np

QUEUE_TUPLES = 1 << 21
TUPLE = np.dtype([("word", "<u8"), ("rank", "<i8"), ("place", "<i8")])
ONES = np.uint64(2**64 - 1)


def in_order(tuples: np.ndarray) -> np.ndarray:
    return tuples[np.lexsort((np.ascontiguousarray(tuples["rank"]), np.ascontiguousarray(tuples["word"])))]


class TupleQueue:
    """Takes tuples (word, rank, place) in any order, gives them back sorted by word and rank.

    Up to ``memory`` tuples are held; more are written as sorted runs to a folder of this task that goes with the
    queue, and merged block by block.
    """

    def __init__(self, memory: int = QUEUE_TUPLES):
        self.memory, self.parts, self.held = memory, [], 0
        self.folder: str | None = None
        self.runs: list[str] = []

    def __enter__(self) -> TupleQueue:
        return self

    def __exit__(self, *_: object) -> None:
        if self.folder:
            shutil.rmtree(self.folder, ignore_errors=True)

    def push(self, word: np.ndarray, rank: np.ndarray, place: np.ndarray) -> None:
        for at in range(0, len(word), self.memory):
            part = np.empty(len(word[at : at + self.memory]), TUPLE)
            for name, values in (("word", word), ("rank", rank), ("place", place)):
                part[name] = values[at : at + self.memory]
            if self.held and self.held + len(part) > self.memory:
                self._spill()
            self.parts.append(part)
            self.held += len(part)

    def _sorted(self) -> np.ndarray:
        all_ = self.parts[0] if len(self.parts) == 1 else np.concatenate([np.empty(0, TUPLE), *self.parts])
        self.parts, self.held = [], 0
        return in_order(all_)

    def _spill(self) -> None:
        self.folder = self.folder or tempfile.mkdtemp(prefix="suffix-runs-")
        self.runs.append(os.path.join(self.folder, f"{len(self.runs)}.npy"))
        np.save(self.runs[-1], self._sorted())

    def pop(self) -> Iterator[np.ndarray]:
        """Sorted batches; tuples with one word are in one batch."""
        last = self._sorted()
        if not self.runs:
            if len(last):
                yield last
            return
        sources = [np.load(r, mmap_mode="r") for r in self.runs] + [last]
        block = max(1, self.memory // len(sources))
        at = [0] * len(sources)
        while any(i < len(s) for i, s in zip(at, sources)):
            # the least of the blocks' last words: all up to it is within the blocks, but for its own ties
            bound = min(s[min(i + block, len(s)) - 1]["word"] for i, s in zip(at, sources) if i < len(s))
            taken = []
            for j, s in enumerate(sources):
                end = at[j] + int(np.searchsorted(s["word"][at[j] : at[j] + block], bound, "right"))
                while end == at[j] + len(s[at[j] : end]) and end < len(s) and end > at[j] and s[end]["word"] == bound:
                    end += int(np.searchsorted(s["word"][end : end + block], bound, "right"))
                taken.append(np.asarray(s[at[j] : end]))
                at[j] = end
            batch = np.concatenate(taken)
            yield in_order(batch)


class LeastBetween:
    """Least value between two places of an array, for many pairs at once."""

    def __init__(self, values: np.ndarray):
        self.levels = [values.astype(np.uint16 if values.max() < 1 << 16 else np.int64)]
        step = 1
        while 2 * step <= len(values):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))
            step *= 2

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of values[low + 1 .. high], low < high."""
        out = np.empty(len(low), self.levels[0].dtype)
        level = np.log2(high - low).astype(np.int8)
        for k in np.unique(level).tolist():
            some = np.flatnonzero(level == k)
            values = self.levels[k]
            out[some] = np.minimum(values[low[some] + 1], values[high[some] + 1 - (1 << k)])
        return out


class Level:
    """A string of symbols, its samples, and the byte position of every symbol.

    ``differing`` gives the common bytes of the suffixes at places whose first symbols differ.
    """

    def __init__(self, symbols: np.ndarray, at: np.ndarray, differing: Callable, limit: int, memory: int):
        self.symbols, self.at, self.differing, self.limit, self.memory = symbols, at, differing, limit, memory
        n = len(symbols)
        self.n, self.bits = n, max(8, (int(symbols.max()) + 1).bit_length())
        self.width = 64 // self.bits
        padded = np.concatenate([symbols, np.zeros(self.width, symbols.dtype)]).astype(np.uint64)
        self.words = np.zeros(n, np.uint64)
        for k in range(self.width):
            self.words |= padded[k : k + n] << np.uint64(64 - self.bits * (k + 1))
        self.pads = np.array([int(ONES) >> (self.bits * k) for k in range(self.width)] + [0], np.uint64)
        change = np.flatnonzero(symbols[1:] != symbols[:-1])
        ends = np.concatenate([change, [n - 1]])  # last place of each run of one symbol
        rising = np.zeros(len(ends), bool)
        rising[:-1] = symbols[change + 1] > symbols[change]
        starts = np.concatenate([[0], change + 1])
        self.samples = starts[np.flatnonzero(rising[1:] & ~rising[:-1]) + 1]
        #: for each place the number of the first sample after it; the count of samples stands for the end
        self.next_sample = np.zeros(n, np.int32)
        self.next_sample[self.samples] = 1
        self.next_sample = np.cumsum(self.next_sample, dtype=np.int32)
        self.ends = np.concatenate([self.samples + 1, [n]])

    def length(self, places: np.ndarray, sample: np.ndarray) -> np.ndarray:
        """Symbols up to and with the sample's first."""
        return self.ends[sample] - places

    def word(self, places: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
        """The depth-th word of stretches, padded with the largest symbol."""
        left = np.clip(lengths - depth * self.width, 0, self.width)
        return self.words[np.minimum(places + depth * self.width, self.n - 1)] | self.pads[left]

    def refine(self, batch: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, new) of a batch sorted by first word and rank: by all words and rank, and where a stretch differs
        from the one before.

        Only groups of one word with a stretch that goes on are looked at again.
        """
        places, ranks = np.ascontiguousarray(batch["place"]), np.ascontiguousarray(batch["rank"])
        order, new = np.arange(len(batch)), np.ones(len(batch), bool)
        new[1:] = batch["word"][1:] != batch["word"][:-1]
        where, group, depth = order, np.cumsum(new) - 1, 1
        while True:
            longer = lengths[order[where]] > depth * self.width
            if not longer.any():
                return order, new
            size = np.bincount(group)
            keep = ((size > 1) & (np.bincount(group[longer], minlength=len(size)) > 0))[group]
            where, group = where[keep], group[keep]
            if not len(where):
                return order, new
            entry = order[where]
            word = self.word(places[entry], lengths[entry], depth)
            by = np.lexsort((ranks[entry], word, group))
            order[where], word = entry[by], word[by]
            other = np.ones(len(where), bool)
            other[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
            new[where] |= other
            group = np.cumsum(other) - 1
            depth += 1

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common bytes of suffixes that differ before either ends, compared word by word, up to the limit."""
        out = np.zeros(len(a), np.int64)
        open_, q = np.arange(len(a)), 0
        while len(open_):
            x, y = a[open_] + q, b[open_] + q
            mixed = self.words[x] ^ self.words[y]
            done = mixed != 0
            if done.any():
                high = np.frexp((mixed[done] >> np.uint64(11)).astype(np.float64))[1] + 11
                small = mixed[done] < 1 << 11
                high[small] = np.frexp(mixed[done][small].astype(np.float64))[1]
                k = q + (64 - high) // self.bits
                x, y = a[open_[done]], b[open_[done]]
                out[open_[done]] = self.at[x + k] - self.at[x] + self.differing(x + k, y + k)
            q += self.width
            far = self.at[np.minimum(a[open_] + q, self.n)] - self.at[a[open_]] >= self.limit
            out[open_[~done & far]] = self.limit
            open_ = open_[~done & ~far]
        return np.minimum(out, self.limit)

    def induce(self, places: np.ndarray, ranks: np.ndarray, between: Callable | None):
        """Yield (places in suffix order, common bytes with the one before, whether its stretch is new) in batches.

        ``ranks`` has each sample's rank and -1 for the end; without ``between`` only stretches are compared.
        """
        with TupleQueue(self.memory) as queue:
            for at in range(0, len(places), self.memory):
                part = places[at : at + self.memory]
                sample = self.next_sample[part]
                queue.push(self.word(part, self.length(part, sample), 0), ranks[sample], part)
            before = np.zeros(0, np.int64)
            for batch in queue.pop():
                batch_places = batch["place"]
                sample = self.next_sample[batch_places]
                lengths = self.length(batch_places, sample)
                order, new = self.refine(batch, lengths)
                place, rank, length = batch_places[order], batch["rank"][order], lengths[order]
                common = np.zeros(len(place), np.int64)
                i = np.flatnonzero(new[1:]) + 1
                common[i] = self.shared(place[i - 1], place[i])
                if len(before):
                    common[:1] = self.shared(before, place[:1])
                if between is not None:
                    i = np.flatnonzero(~new)
                    if len(i):
                        # the last symbol of a stretch is the first of the sample
                        ahead = self.at[place[i] + length[i] - 1] - self.at[place[i]]
                        common[i] = np.minimum(ahead + between(rank[i - 1], rank[i]), self.limit)
                before = place[-1:]
                yield place, common, new


def suffixes(symbols: np.ndarray, limit: int, wanted: np.ndarray | None = None, memory: int = QUEUE_TUPLES):
    """(places, common): the wanted places in suffix order, and each one's common symbols with the one before, up to ``limit``.

    ``symbols`` are bytes; the last must occur nowhere else.
    """
    at = np.arange(len(symbols) + 1)
    level = Level(symbols, at, lambda a, b: 0, limit, memory)
    return _solve(level, np.arange(len(symbols)) if wanted is None else wanted)


def _solve(level: Level, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = len(level.samples)
    ranks, between = np.full(count + 1, -1, np.int64), None
    if count:
        # stretches from sample to sample, sorted and named
        found = list(level.induce(level.samples, np.zeros(count + 1, np.int64), None))
        order, common, new = (np.concatenate(x) for x in zip(*found))
        names = np.cumsum(new) - 1
        sample = np.searchsorted(level.samples, order)
        if new.all():
            ranks[sample] = names
        else:
            reduced = np.empty(count, np.uint32)
            reduced[sample] = names

            def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                return level.shared(level.samples[a], level.samples[b])

            at = np.concatenate([level.at[level.samples], level.at[level.n :]])
            order, common = _solve(Level(reduced, at, differing, level.limit, level.memory), np.arange(count))
            ranks[order] = np.arange(count)
        between = LeastBetween(common)
    found = list(level.induce(wanted, ranks, between or (lambda a, b: 0)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
