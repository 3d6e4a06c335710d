"""Language identification by unigram piece models whose segmentations are summed out.

Pieces are those of a fixed public vocabulary. Each language has a probability per piece, learned by expectation
maximisation over the counts of all words of the sample, pieces and words of any length. A word's probability in a language is the sum over all its segmentations into pieces,
computed by the forward algorithm for many words and all languages at once; a text's is the product over its words.

Words are maximal runs of letters of the lower-cased text, with the vocabulary's word mark in front. Distinct tokens
are scored once per task and kept while their characters stay under a bound; beyond it the cache is emptied, which
costs time and changes nothing.

Defined cases: texts that are null or have no letter are ``und`` with score 0, as is everything if no row can teach a
language; null languages teach nothing; a null doc_id counts as an empty one for the split; equal rows get equal
results; ties go to the first language by code point; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.common import rows_of, saved, table

VOCABULARY = "piece_bpe_32k.model"
#: about so many labelled rows of each language are learned from, chosen by a hash of the id
ROWS_PER_LANGUAGE = 2000
ROUNDS, SMOOTHING, UNKNOWN = 3, 0.05, 1e-7
MARK = "▁"
CELLS, CACHED_CHARS = 1 << 20, 4_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
LETTERS = regex.compile(r"\p{L}+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def hashes(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes (rows, columns + 1) of rows of character codes."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + codes[:, i]
    return out


def coded(words: list[str], width: int) -> np.ndarray:
    """Character codes plus one of words, padded with 0."""
    out = np.zeros((len(words), width), np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    rows = np.repeat(np.arange(len(words)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Pieces:
    """The vocabulary as hashes; ``find`` gives piece numbers, or -1."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        all_ = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        self.pieces = sorted({p for p in all_ if p == p.lower() and regex.fullmatch(rf"{MARK}?\p{{L}}*", p)})
        self.longest = max(map(len, self.pieces), default=1)
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, BASE)]))
        keys = np.concatenate([hashes(coded([p], len(p)))[:, -1] for p in self.pieces])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


@lru_cache(2)
def pieces_at(path: str) -> Pieces:
    return Pieces(path)


def edges(vocabulary: Pieces, prefix: np.ndarray, end: int, live: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, pieces) of what may end at a position in the first ``live`` rows; single unknown characters are piece -1."""
    out = []
    for k in range(1, min(vocabulary.longest, end) + 1):
        found = vocabulary.find(prefix[:live, end] - prefix[:live, end - k] * vocabulary.powers[k])
        rows = np.arange(live) if k == 1 else np.flatnonzero(found >= 0)
        if len(rows):
            out.append((k, rows, found[rows]))
    return out


def batches_by_length(words: list[str]):
    """Index lists of words of like length, longest first in each, of at most CELLS padded characters (or one word)."""
    order, start = sorted(range(len(words)), key=lambda i: -len(words[i])), 0
    while start < len(order):
        size = max(1, CELLS // (len(words[order[start]]) + 1))
        yield order[start : start + size]
        start += size


def forward(vocabulary: Pieces, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural logs (words, languages) of the sum over all segmentations; ``probability`` has a last row for unknown."""
    out = np.zeros((len(words), probability.shape[1]))
    for part in batches_by_length(words):
        marked = [MARK + words[i] for i in part]
        width = len(marked[0])
        prefix = hashes(coded(marked, width))
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        size = vocabulary.longest + 1
        ring = np.zeros((size, len(part), probability.shape[1]))
        ring[0] = 1
        scale = np.zeros((len(part), probability.shape[1]))
        for end in range(1, width + 1):
            live = int(np.searchsorted(-lengths, -end, side="right"))
            now = ring[end % size]
            now[:live] = 0
            for k, rows, found in edges(vocabulary, prefix, end, live):
                now[rows] += ring[(end - k) % size, rows] * probability[found]
            if end % 16 == 0:  # keep the numbers in range
                top = np.maximum(now[:live], 1e-300)
                ring[:, :live] /= top
                scale[:live] += np.log(top)
            done = np.flatnonzero(lengths[:live] == end)
            out[np.asarray(part)[done]] = np.log(np.maximum(now[done], 1e-300)) + scale[done]
    return out


def expected(vocabulary: Pieces, probability: np.ndarray, words: list[str], languages: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected uses (pieces + 1, languages) of each piece, by forward and backward sums over each word's segmentations."""
    out = np.zeros_like(probability)
    for part in batches_by_length(words):
        marked = [MARK + words[i] for i in part]
        width, of, weight = len(marked[0]), languages[part], counts[part]
        prefix = hashes(coded(marked, width))
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        before = np.zeros((width + 1, len(part)))
        before[0] = 1
        steps = []
        for end in range(1, width + 1):
            live = int(np.searchsorted(-lengths, -end, side="right"))
            found = [(k, rows, piece, probability[piece, of[rows]]) for k, rows, piece in edges(vocabulary, prefix, end, live)]
            for k, rows, _, p in found:
                before[end, rows] += before[end - k, rows] * p
            steps.append(found)
        after = np.zeros((width + 1, len(part)))
        after[lengths, np.arange(len(part))] = 1
        total = np.maximum(before[lengths, np.arange(len(part))], 1e-300)
        for end in range(width, 0, -1):
            for k, rows, piece, p in steps[end - 1]:
                use = before[end - k, rows] * p * after[end, rows]
                np.add.at(out, (piece, of[rows]), use / total[rows] * weight[rows])
                after[end - k, rows] += p * after[end, rows]
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, path: str | None = None) -> tuple[list[str], np.ndarray]:
    """(languages, probability) learned from the labelled rows that are not held out."""
    path = path or vocabulary_path()
    vocabulary = pieces_at(path)
    rows = docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = dict(rows.groupBy("lang").count().collect())  # a row per language
    names = sorted(sizes)
    if not names:
        return [], np.ones((len(vocabulary.pieces) + 1, 0))
    share = F.create_map(*chain(*((F.lit(n), F.lit(min(1.0, rows_per_language / sizes[n]))) for n in names)))
    chance = F.pmod(F.xxhash64("doc_id", "lang", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(chance < F.try_element_at(share, F.col("lang")))
    place = {n: i for i, n in enumerate(names)}

    def count(batches):
        for batch in batches:
            found: dict[tuple[int, str], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word in LETTERS.findall(text.lower()):
                    found[place[lang], word] = found.get((place[lang], word), 0) + 1
            langs, words = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.int32()), pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())], ["place", "word", "n"])

    words = sample.mapInArrow(count, "place int, word string, n long").groupBy("place", "word").agg(F.sum("n").alias("n"))
    words = saved(words, "language-words")
    spark, size = docs.sparkSession, len(vocabulary.pieces)
    probability = np.full((size + 1, len(names)), 1.0 / size)
    probability[-1] = UNKNOWN
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(probability)  # pieces x languages, whatever the corpus holds

        def expect(batches):
            total = 0
            for b in batches:
                args = b.column("word").to_pylist(), b.column("place").to_numpy(), b.column("n").to_numpy()
                total = total + expected(pieces_at(path), shared.value, *args)
            if not isinstance(total, int):
                piece, lang = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "place", "uses"])

        uses = words.mapInArrow(expect, "piece int, place int, uses double").groupBy("piece", "place").agg(F.sum("uses").alias("uses")).toPandas()
        counts = np.zeros_like(probability)
        counts[uses["piece"], uses["place"]] = uses["uses"]
        probability = (counts[:-1] + SMOOTHING) / (counts[:-1].sum(0) + SMOOTHING * size)
        probability = np.vstack([probability, np.full((1, len(names)), UNKNOWN)])
        shared.destroy()
    return names, probability


class Scorer:
    """Scores tokens, each distinct one once while the cache lasts."""

    def __init__(self, path: str, probability: np.ndarray):
        self.vocabulary, self.probability = pieces_at(path), probability
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, self.probability.shape[1] + 1))
        self.chars = 0

    def learn(self, tokens: set[str]) -> None:
        fresh = list(tokens.difference(self.place))
        if self.chars + sum(map(len, fresh)) > CACHED_CHARS:
            self.clear()
            fresh = list(tokens)
        if not fresh:
            return
        words = [LETTERS.findall(t) for t in fresh]
        distinct = list(set(chain(*words)))
        score = forward(self.vocabulary, self.probability, distinct)
        at = {w: i for i, w in enumerate(distinct)}
        rows = np.zeros((len(fresh), self.probability.shape[1] + 1))
        owner = np.repeat(np.arange(len(fresh)), list(map(len, words)))
        word = np.fromiter((at[w] for ws in words for w in ws), np.int64, len(owner))
        for j in range(score.shape[1]):
            rows[:, j] = np.bincount(owner, score[word, j], len(fresh))
        rows[:, -1] = np.bincount(owner, minlength=len(fresh))
        self.place.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
        self.known = np.vstack([self.known, rows])
        self.chars += sum(map(len, fresh))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages + 1): log probabilities and the number of words."""
        split = [(t or "").lower().split() for t in texts]
        self.learn(set().union(*split))
        out = np.zeros((len(texts), self.known.shape[1]))
        for i, tokens in enumerate(split):
            if tokens:
                used = np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))
                out[i] = self.known[used].sum(0)
        return out


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray], path: str | None = None, columns: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` (any columns, one of them text) with two columns: the language, and its probability given the text."""
    path, (names, probability) = path or vocabulary_path(), model
    shared = docs.sparkSession.sparkContext.broadcast(probability)
    inner = docs.drop(*columns)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields), f"{columns[0]} string", f"{columns[1]} double"])

    def run(batches):
        scorer = Scorer(path, shared.value)
        for batch in batches:
            found: list[str] = []
            sure: list[float] = []
            for _, texts in rows_of(batch, "text", 512):
                if not names:
                    found += ["und"] * len(texts)
                    sure += [0.0] * len(texts)
                    continue
                score = scorer.score(texts)
                logs = score[:, :-1]
                best = logs.argmax(1)
                share = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                some = score[:, -1] > 0
                found += [names[b] if s else "und" for b, s in zip(best, some)]
                sure += np.where(some, share, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(sure, pa.float64())], [*batch.schema.names, *columns])

    return inner.mapInArrow(run, schema)


def op8_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(narrow, fit(docs)).select("doc_id", "held_out", "lang_pred", "score")
