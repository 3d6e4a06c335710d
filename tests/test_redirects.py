"""Redirect chains against walking them one by one."""

import random

from pyspark.sql import functions as F

from crawlspark.operators import redirects as R


def brute(rows):
    one = {}
    for src, dst, temp in rows:
        if src is not None and dst is not None and src != dst:
            one.setdefault(src, []).append((dst, temp is not None, bool(temp)))
    one = {s: (min(found)[0], min(found)[2]) for s, found in one.items()}
    out = {}
    for src in one:
        at, hops, temp, seen = src, 0, False, {src}
        while at in one:
            at, hop = one[at]
            hops, temp = hops + 1, temp or hop
            if at in seen:
                out[src] = (src, 0, False, True)
                break
            seen.add(at)
        else:
            out[src] = (at, hops, temp, False)
    return out


def test_random_graphs(spark):
    for seed, size in ((1, 12), (2, 60), (3, 300)):
        rng = random.Random(seed)
        rows = [(f"u{rng.randrange(size)}", f"u{rng.randrange(size + size // 3)}", rng.choice([True, False, None])) for _ in range(size)]
        rows += [(f"c{i}", f"c{i + 1}", i == 40) for i in range(45)] + [("c45", "u1", False), ("self", "self", True), (None, "u1", True), ("u2", None, True)]
        rows += [(f"h{i}", "hub", False) for i in range(200)] + [("hub", "end", True), ("x", "y", False), ("y", "x", False), ("into", "x", True)] + rows[:3]
        found = R.follow_redirects(spark.createDataFrame([(*r, "other") for r in rows], "src string, dst string, temp boolean, hops string"))
        assert {r["src"]: tuple(r)[1:] for r in found.collect()} == brute(rows)
        assert found.count() == len(brute(rows))


def test_canonical_urls(spark):
    rows = [
        ("http://www.a.com/", "http://www.a.com/x", False), ("http://www.a.com/x", "http://www.a.com/x/y", False),
        ("http://b.com/1", "http://b.com/2", False), ("http://b.com/2", "http://b.com/1", False),
    ]
    suffixes = spark.createDataFrame([("com", "IN_USE", 1.0, "GENERIC")], "domain string, status string, boost double, type string")
    found = {r["src"]: r["chosen"] for r in R.canonical_urls(spark.createDataFrame(rows, "src string, dst string, temp boolean"), suffixes).collect()}
    # a permanent redirect away from a site's root keeps the root, from elsewhere its end; a cycle's urls stand for themselves
    assert found == {
        "http://www.a.com/": "http://www.a.com/", "http://www.a.com/x": "http://www.a.com/x/y",
        "http://b.com/1": "http://b.com/1", "http://b.com/2": "http://b.com/2",
    }


def test_empty(spark):
    none = spark.createDataFrame([], "src string, dst string, temp boolean")
    assert R.follow_redirects(none).count() == 0 and R.follow_redirects(none.union(none).where(F.lit(True))).columns[0] == "src"
