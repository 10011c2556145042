import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from linkloom.llm import simhash
from linkloom.llm.components import connected


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{position: smallest id reachable} of (id, fingerprint) rows."""
    left, out = set(range(len(rows))), {}
    while left:
        queue = [left.pop()]
        own = list(queue)
        while queue:
            x = queue.pop()
            near = {y for y in left if (rows[x][1] ^ rows[y][1]).bit_count() <= 3}
            left -= near
            queue += near
            own += near
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        out |= dict.fromkeys(own, min(ids, default=None))
    return out


def test_against_brute_force(frame, documents):
    rows = [(d, plain_fingerprint(t)) for d, t in documents]
    roots = plain_components(rows)
    want = sorted((str(d), f"{fp:016x}", str(roots[i])) for i, (d, fp) in enumerate(rows))
    got = simhash.near_duplicates(frame).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_spark_hash_is_the_same(spark):
    texts = ["", "a", "the of and", "é" * 50]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert [x & (1 << 64) - 1 for x in got] == [xxhash.xxh64_intdigest(t.encode(), seed=42) for t in texts]


def test_links_of_planted_fingerprints(spark):
    rng = np.random.default_rng(1)
    prints = {0}
    for _ in range(30):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(12):
            prints.add(x)
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(b)
    prints = sorted(prints)
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    roots = {r["node"] & (1 << 64) - 1: r["root"] for r in connected(simhash.links(table), "a", "b").collect()}
    want = plain_components([(x, x) for x in prints])
    groups = defaultdict(set)
    for i, x in enumerate(prints):
        groups[roots.get(x, x)].add(want[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_dense_bucket_gives_a_forest():
    prints = np.unique(np.array([sum(1 << int(b) for b in c) for c in np.random.default_rng(3).integers(0, 12, (3000, 4))], np.uint64))
    roots, members = simhash.forest(prints)
    assert sum(map(len, members)) < len(prints)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 7), (200, 201), (201, 200), (300, 300), (None, 1)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {**dict.fromkeys([*range(51), 100], 0), 200: 200, 201: 200}


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_large_buckets_against_all_pairs():
    """Prints of one bucket, dense and thin, for each masked block."""
    rng = np.random.default_rng(8)
    for block in range(4):
        for n in (30, 400, 3000):
            key = np.uint64(rng.integers(0, 1 << 63)) & ~np.uint64(0xFFFF << 16 * block) | np.uint64(block + 1 << 16 * block)
            values = rng.integers(0, 1 << 16, n).astype(np.uint64) << np.uint64(16 * block)
            places = np.array([b for b in range(64) if not 16 * block <= b < 16 * block + 16], np.uint64)
            flips = np.where(rng.random(n) < 0.3, np.uint64(0), np.uint64(1) << rng.choice(places, n))
            prints = np.unique((key & ~np.uint64(0xFFFF << 16 * block) | values) ^ flips)
            found = []
            for roots, members in (simhash.forest(prints), simhash.dense_forest(prints, key)):
                part = {int(p): int(p) for p in prints}
                for r, m in zip(np.concatenate(roots) if roots else [], np.concatenate(members) if members else [], strict=True):
                    part[int(m)] = int(r)
                groups = {}
                for p in part:
                    top = p
                    while part[top] != top:
                        top = part[top]
                    groups.setdefault(top, set()).add(p)
                found.append(sorted(map(sorted, groups.values())))
            assert found[0] == found[1]
