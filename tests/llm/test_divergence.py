"""The source audit against dense sums in Python integers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from crawlspark.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top=50):
    """The result's rows, from (lang, source, text)."""
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang or "", source or ""].update(found)
        held[lang or ""].update(set(found))
    out = []
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= least]
        own = {s: counts for (at, s), counts in groups.items() if at == lang}

        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        shares, q = {s: share(c) for s, c in own.items()}, share(sum(own.values(), Counter()))
        for s, p in shares.items():
            pairs = [(-sum(abs(p[t] - other[t]) for t in kept), o.encode(), o) for o, other in shares.items() if o != s]
            terms = [(q[t] - p[t], t.encode(), t) for t in kept if own[s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(12)
    rows = []
    words = {"en": [f"{a}{b}" for a in "abcdefgh" for b in "xyzwv"], "fr": ["été", "ÉTÉ", "où", "日本", "na", "no"], None: ["it", "is"]}
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "fr", None])
        source = rng.choice(["hot"] * 6 + [f"s{j}" for j in range(9)] + [None, "é", "Z"])
        pool = words[lang][: rng.randint(1, len(words[lang]))]
        rows.append((lang, source, rng.choice([" ", "9", "[", "\x00", "\n"]).join(rng.choice(pool) for _ in range(rng.randint(0, 30))).title()))
    rows += [("en", "hot", "ax ay az " * 20_000), ("en", "empty", None), ("en", "empty", "123 ..."), ("xx", "a", "rare words"), ("xx", "b", ""), ("yy", "alone", "once")]
    return rows + [rows[0]] * 3


@pytest.mark.parametrize("settings", [{}, {"postings": 40, "cells": 30, "counters": 64}])
def test_against_brute_force(spark, settings):
    rows = corpus()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # blocks must meet their peers in any partition
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, g int").repartition(5)
    found = D.audit(docs, least=12, **settings)
    assert found.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 12)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_steps_and_large_counts():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    groups, terms = 7, 50
    p = rng.integers(1, 10**9, (groups, terms))
    zero = rng.integers(1, 1000, groups)
    has = rng.random((groups, terms)) < 0.6
    g, t = np.nonzero(has)
    found = pa.table({"term": [f"t{x}" for x in t], "g": pa.array(g, pa.int32()), "p": p[g, t]})
    dense = np.where(has, p, zero[:, None])
    for step in (1, 3, 1 << 18):
        D.STEP, old = step, D.STEP
        sums = Counter()
        for a, b, value in zip(*D.accumulators(found, zero, terms, range(groups))):
            sums[int(a), int(b)] += int(value)
        D.STEP = old
        assert sums == {(a, b): int(np.abs(dense[a] - dense[b]).sum()) for a in range(groups) for b in range(a + 1, groups)}


def test_empty(spark):
    docs = spark.createDataFrame(corpus()[:3], "lang string, source string, text string")
    assert D.audit(docs.where(F.lit(False))).count() == 0
    assert {r["value"] for r in D.audit(spark.createDataFrame(corpus(), "lang string, source string, text string"), least=10**6).collect()} == {0}
