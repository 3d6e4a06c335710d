"""How the sources of a language differ in their use of terms: smoothed shares, compared between all sources and with the language.

A language keeps the V terms that at least LEAST_DOCUMENTS of its documents hold. A group is a (lang, source); with N occurrences of kept terms it gives a
term that occurs n times there the integer share p = 1 + floor(SCALE * (n + PRIOR) / (N + PRIOR * V)). Two groups differ by the sum of
abs(p - q) over all kept terms, also those that neither has.

Those sums are a product of sparse rows, made row by row (Gustavson): the terms of a language are dealt to blocks, and a block's postings (term, group, p) are its
term-major index. Each group scatters its terms through the index into a dense accumulator with a cell per peer. A peer without the term
has the share z of a term that it never uses, so with z and z' for the two groups

    sum abs(p - q) = V * abs(z - z') + sum over own terms (abs(p - z') - abs(z - z')) + the same for the peer
                     + sum over common terms (abs(p - q) - abs(p - z') - abs(z - q) + abs(z - z'))

where only the last sum needs the index; the second runs over the distinct shares of a row. No pair of postings leaves a task, only a row's accumulator, and those
of all blocks are added by a group-by. A table of hashed counters of documents (``tally``, never too low) first rules out most of the terms that too few
documents of a language hold, so that they are not shuffled; the rest are counted exactly. Counts are made in tasks and added map-side, so a source with a third of all rows is no larger than another after that.
A language of many groups deals the rows of a block to several tasks, so that the accumulators that a task returns have at most CELLS cells.

Defined cases: null text, lang and source are ''; texts without terms leave their group with N = 0, and languages without kept terms have pairs
of value 0; equal rows count once each; a language's only source has no pairs; texts of any length are counted whole;
no documents give no rows; columns other than text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.llm.common import rows_of, saved, table
from crawlspark.llm.tally import tally

LEAST_DOCUMENTS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: postings of a block, accumulator cells that a task returns, postings looked at together, terms counted before they are handed on
POSTINGS, CELLS, STEP, HELD = 500_000, 4_000_000, 1 << 18, 300_000
#: hashed counters
COUNTERS = 1 << 25

#: A-Z to a-z, a-z and bytes of other alphabets to themselves, all else to a space
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased."""
    return text.encode().translate(NORMAL).split()


def hashed(lang: str, terms) -> np.ndarray:
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    return np.fromiter((xxh64_intdigest(t, seed) for t in terms), np.uint64, len(terms))


def likely(docs: DataFrame, least: int, counters: int) -> np.ndarray:
    """A bit per cell: whether (lang, term) of that cell may be held by ``least`` documents."""
    most = min(255, max(0, least))

    def hashes(batch):
        held: dict[str, Counter] = {}
        for start, texts in rows_of(batch, "text", 256):
            for lang, text in zip(batch.column("lang").slice(start, len(texts)).to_pylist(), texts):
                held.setdefault(lang, Counter()).update(set(terms_of(text)))
            if start + 256 >= batch.num_rows or sum(map(len, held.values())) > HELD:
                for lang, counts in held.items():
                    times = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), most)
                    yield np.repeat(hashed(lang, counts), times)
                held.clear()

    return tally(docs, hashes, counters, max(1, most), lambda n: np.packbits(n >= most))


def term_counts(docs: DataFrame, least: int, counters: int) -> DataFrame:
    """(lang, source, term, n, df): occurrences of each term in a group, and documents that hold it, of all terms that ``least`` documents
    of the language may hold."""
    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    shared = docs.sparkSession.sparkContext.broadcast(likely(named.select("lang", "text"), least, counters))  # counters / 8 bytes

    def rows(key: tuple[str, str], every: Counter, held: Counter) -> pa.RecordBatch:
        at = (hashed(key[0], every) & np.uint64(counters - 1)).astype(np.int64)
        kept = np.flatnonzero(shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)
        terms = list(every)
        terms = [terms[i] for i in kept.tolist()]
        columns = [
            pa.array([key[0]] * len(terms), pa.string()),
            pa.array([key[1]] * len(terms), pa.string()),
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array([every[t] for t in terms], pa.int64()),
            pa.array([held[t] for t in terms], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "df"])

    def run(batches):
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            for start, texts in rows_of(batch, "text", 256):
                keys = zip(*(batch.column(c).slice(start, len(texts)).to_pylist() for c in ("lang", "source")))
                for key, text in zip(keys, texts):
                    if found := terms_of(text):
                        if key not in counts:
                            counts[key] = (Counter(), Counter())
                        every, held = counts[key]
                        every.update(found)
                        held.update(set(found))
                if sum(len(every) for every, _ in counts.values()) > HELD:
                    for key, (every, held) in counts.items():
                        yield rows(key, every, held)
                    counts.clear()
        for key, (every, held) in counts.items():
            yield rows(key, every, held)

    found = named.mapInArrow(run, "lang string, source string, term string, n bigint, df bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * kept)), exact; null without kept terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * wide(n + PRIOR)
    return F.when(kept > 0, F.lit(1) + F.call_function("div", top, wide(F.nullif(total + PRIOR * kept, F.lit(0)))))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, postings: int = POSTINGS, cells: int = CELLS, counters: int = COUNTERS) -> DataFrame:
    """(lang, source, part, item, value, rank): the pairs of a group with all other sources, and its ``top`` terms above the language's share."""
    docs = docs.select("lang", "source", "text")
    counts = saved(term_counts(docs, least, counters), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("all")).where(F.col("df") >= least).drop("df")
    kept = saved(kept, "divergence-kept")
    own = saved(counts.drop("df").join(kept.drop("all"), ["lang", "term"], "left_semi"), "divergence-own")

    names = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("whole"))
    groups = names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "whole"])
    by_lang = Window.partitionBy("lang")
    groups = groups.withColumn("g", F.row_number().over(by_lang.orderBy("source")) - 1).withColumn("peers", F.count("*").over(by_lang))
    groups = groups.withColumn("zero", F.coalesce(share(F.lit(0), F.col("total"), F.col("v")), F.lit(0)))
    groups = saved(groups, "divergence-groups")

    shares = own.join(groups, ["lang", "source"]).select("lang", "source", "term", "g", "peers", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    shares = saved(shares, "divergence-shares")
    common = kept.join(langs, "lang").select("lang", "term", share(F.col("all"), F.col("whole"), F.col("v")).alias("q"))
    terms = shares.join(common, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = ranked(terms, "term").where(F.col("rank") <= top)

    sums = saved(pair_sums(shares, groups, postings, cells), "divergence-sums")
    both = sums.union(sums.select("lang", F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    first = groups.select("lang", "g", "source")
    second = groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))
    pairs = ranked(both.join(first, ["lang", "g"]).join(second, ["lang", "h"]).select("lang", "source", "item", "value"), "pair")
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order))


def pair_sums(shares: DataFrame, groups: DataFrame, postings: int, cells: int) -> DataFrame:
    """(lang, g, h, value) of all pairs g < h of a language's groups."""
    blocks = max(1, -(-shares.count() // postings))
    # the rows of a language with many groups are dealt to several tasks, each with the index of the block
    tasks = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("peers") * F.col("peers") / cells)).cast("int") - 1)).alias("task")
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block")
    index = shares.select("lang", block, tasks, "term", "g", "p")
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("lang", "block", tasks, "g", "peers", "zero", "v")
    keys = ["lang", "block", "task"]

    def run(key: tuple, found: pa.Table, peers: pa.Table) -> pa.Table:
        lang, number, task = (k.as_py() for k in key)
        zero = np.zeros(peers.num_rows, np.int64)
        zero[peers.column("g").to_numpy()] = peers.column("zero").to_numpy()
        tasks = -(-len(zero) ** 2 // cells)
        v = peers.column("v")[0].as_py() if number == 0 else None
        g, h, value = accumulators(found, zero, v, range(task, len(zero), max(1, tasks)))
        return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "g": pa.array(g, pa.int32()), "h": pa.array(h, pa.int32()), "value": pa.array(value, pa.int64())})

    sums = index.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(run, "lang string, g int, h int, value bigint")
    return sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def accumulators(found: pa.Table, zero: np.ndarray, v: int | None, rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(g, h, value), g < h, of the accumulators of ``rows``, groups by number: the terms of one block (term, g, p), of which group h has ``zero[h]`` if it
    has none. The same pair may come from both of its rows. ``v`` adds the part of all kept terms, in one block."""
    term = found.column("term").combine_chunks().dictionary_encode().indices.to_numpy() if found.num_rows else np.zeros(0, np.int64)
    group, p = found.column("g").to_numpy().astype(np.int64), found.column("p").to_numpy()
    by_term = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[by_term], np.arange(term.max() + 2 if len(term) else 1))
    index_group, index_p = group[by_term], p[by_term]
    by_group = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[by_group], np.arange(len(zero) + 1))
    none, out = np.zeros(len(zero), np.int64), []
    for g in rows:
        own = by_group[bounds[g] : bounds[g + 1]]
        if not len(own) and v is None:
            continue
        apart = np.abs(zero[g] - zero)
        peers = none.copy()
        values, times = np.unique(p[own], return_counts=True)
        for value, n in zip(values, times):
            peers += n * (np.abs(value - zero) - apart)
        later = none.copy() if v is None else v * apart
        lengths = starts[term[own] + 1] - starts[term[own]]
        cuts = np.searchsorted(np.cumsum(lengths), np.arange(STEP, lengths.sum() + STEP, STEP))
        for a, b in zip([0, *cuts[:-1] + 1], cuts + 1):
            part, size = own[a:b], lengths[a:b]
            if not size.sum():
                continue
            at = np.repeat(starts[term[part]] - np.cumsum(size) + size, size) + np.arange(size.sum())
            h, q, mine = index_group[at], index_p[at], np.repeat(p[part], size)
            more = h > g
            h, q, mine = h[more], q[more], mine[more]
            np.add.at(later, h, np.abs(mine - q) - np.abs(mine - zero[h]) - np.abs(zero[g] - q) + apart[h])
        peers[g + 1 :] += later[g + 1 :]
        others = np.delete(np.arange(len(zero)), g) if len(own) else np.arange(g + 1, len(zero))
        out.append((np.minimum(g, others), np.maximum(g, others), peers[others]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (none[:0],) * 3


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select lang, source, r, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from (select distinct lang, r, term from w) t group by lang, term having count(*) >= 30),
c as (select lang, source, term, count(*) as n from w join kept using (lang, term) group by all),
v as (select lang, count(*) as v from kept group by lang),
g as (select lang, source, coalesce(sum(n), 0) as total from (select distinct lang, source from d) x left join c using (lang, source) group by all),
dense as (select g.lang, g.source, kept.term, coalesce(n, 0) as n,
                 1 + cast(1000000000 as hugeint) * (coalesce(n, 0) + 5) // cast(total + 5 * v as hugeint) as p
          from g join kept on g.lang = kept.lang join v on g.lang = v.lang
               left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
whole as (select lang, sum(total) as total from g group by lang),
langs as (select kept.lang, kept.term, 1 + cast(1000000000 as hugeint) * (coalesce(sum(n), 0) + 5) // cast(any_value(total) + 5 * any_value(v) as hugeint) as q
          from kept join v using (lang) join whole using (lang) left join c using (lang, term) group by all),
sums as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
         from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select x.lang, x.source, 'pair' as part, y.source as item, cast(coalesce(value, 0) as bigint) as value
          from g x join g y on x.lang = y.lang and x.source <> y.source
               left join sums on sums.lang = x.lang and sums.source = x.source and sums.item = y.source),
terms as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from dense join langs using (lang, term) where n > 0 and p > q)
select * from (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
               from (select * from pairs union all select * from terms) u) z
where part = 'pair' or rank <= 50
"""
