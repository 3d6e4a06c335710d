"""SimHash: fingerprints and links against brute force, components, one document of each group, odd rows."""

import random
import re

import numpy as np
import pytest
import xxhash

from crawlspark.llm import simhash as S
from crawlspark.llm.components import components


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    values = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


TEXTS = [None, "", " \n", "one", "One two", "a b c d", "A b\tc  d e", "É ÀB x y z w", "x y z w v", "k " * 5000, "w" * 50000]


def test_fingerprints():
    assert [S.fingerprint(t) for t in TEXTS] == [plain_fingerprint(t) for t in TEXTS]


def brute(points, most=4):
    points = [int(p) for p in points]
    return {(a, b) for a in points for b in points if a < b and (a ^ b).bit_count() <= most}


def flip(value, rng, most):
    for bit in rng.sample(range(64), rng.randint(1, most)):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_find_every_pair(seed, monkeypatch):
    monkeypatch.setattr(S, "LEAF", 8)
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(600)]
    points += [flip(points[0], rng, 4) for _ in range(150)] + [flip(rng.choice(points), rng, 6) for _ in range(400)]
    points = np.unique(np.array(points, np.uint64))
    found = set()
    for mask in S.masks():
        tree = S.upper_tree(points[::3], mask, 40)
        for _, own, guests in S.route(tree, mask, 1, points):
            for a, b in S.links(own, guests, mask, 1):
                found |= {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())}
    assert found == brute(points)


def plain_components(nodes, pairs):
    root = {n: n for n in nodes}

    def up(n):
        return n if root[n] == n else up(root[n])

    for a, b in pairs:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return {n: up(n) for n in nodes}


def test_components(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5, 5), (2000, 3000)] + [(2000, 4000 + i) for i in range(100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = plain_components({n for p in pairs for n in p}, pairs)
    assert got == {n: r for n, r in want.items() if any(n in p and p[0] != p[1] for p in pairs)}


def corpus(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 6) for _ in range(rng.randint(20, 300))) for _ in range(60)]
    for _ in range(60):
        words = rng.choice(texts[:40]).split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    rows = [(i, t, "clash") for i, t in enumerate(texts + [texts[3]] * 40 + TEXTS)]
    rows += [(7, texts[7], "clash"), (7, texts[7], "clash"), (None, texts[9], "clash"), (None, "alone in the world here", "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, root string")


def test_classes_and_deduplication(spark):
    docs = corpus(spark)
    rows = docs.collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    root = plain_components(set(fps), brute(set(fps)))
    least = {}
    for r, fp in zip(rows, fps):
        if r["doc_id"] is not None:
            least[root[fp]] = min(least.get(root[fp], r["doc_id"]), r["doc_id"])
    got = sorted((str(r["doc_id"]), r["fp"] % 2**64, r["component_id"]) for r in S.classes(docs.select("doc_id", "text")).collect())
    assert got == sorted((str(r["doc_id"]), fp, least.get(root[fp])) for r, fp in zip(rows, fps))
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert sorted(root[plain_fingerprint(r["text"])] for r in kept) == sorted(set(root.values()))
    assert all(r["doc_id"] == least.get(root[plain_fingerprint(r["text"])]) for r in kept)


def test_empty(spark):
    docs = corpus(spark).limit(0)
    assert S.classes(docs.select("doc_id", "text")).count() == 0 and S.deduplicate(docs).count() == 0
