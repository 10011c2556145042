import math

import numpy as np
import pytest

from linkloom.llm import ann


def exact(rows, queries, k):
    out = []
    for qid, q in queries:
        near = sorted((math.sqrt(((np.array(v, float) - np.array(q, float)) ** 2).sum()), i) for i, v in rows if i != qid and len(v) == len(q))
        out += [(qid, rank, i) for rank, (_, i) in enumerate(near[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, shard int, dim int").repartition(3)


def test_recall_on_the_test_table(spark):
    data = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in data.collect()]
    queries = [(i, v) for i, v in rows if i % 100 == 0]
    want = exact(rows, queries, 10)
    got = ann.search(data, data.where("vec_id % 100 = 0")).collect()
    by = {(r["query_id"], r["vec_id"]) for r in got}
    assert sum((q, i) in by for q, _, i in want) >= 0.95 * len(want)
    vectors = dict(rows)
    for r in got:
        assert r["score"] == pytest.approx(math.dist(vectors[r["query_id"]], vectors[r["vec_id"]]), rel=1e-12)


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 150)
    monkeypatch.setattr(ann, "BLOCK", 7)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).astype("float32").tolist()) for i in range(900)]
    data = frame(spark, rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(data, data.where("vec_id % 50 = 0"), k=5, confidence=0.999).collect())
    want = exact(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert len(set(got) & set(want)) >= 0.97 * len(want) and len(got) == len(want)


def test_queries_go_to_cells_within_reach(spark, monkeypatch):
    """Clustered rows: each row stands in one cell, and a query goes to few."""
    monkeypatch.setattr(ann, "SHARD", 100)
    rng = np.random.default_rng(14)
    centres = rng.normal(size=(40, 16)) * 50
    rows = [(i, (centres[i % 40] + rng.normal(size=16)).astype("float32").tolist()) for i in range(4000)]
    data = frame(spark, rows)
    met = []
    near = ann._near
    monkeypatch.setattr(ann, "_near", lambda placed, asked, *rest: met.append((placed.count(), asked.count())) or near(placed, asked, *rest))
    got = {(r["query_id"], r["vec_id"]) for r in ann.search(data, data.where("vec_id % 100 = 0"), k=5).collect()}
    want = exact(rows, [r for r in rows if r[0] % 100 == 0], 5)
    assert sum((q, i) in got for q, _, i in want) >= 0.97 * len(want)
    assert [x for x, _ in met] == [4000, 4000] and met[0][1] == 40 and met[1][1] <= 40 * 8


def test_hot_cells_and_many_queries(spark, monkeypatch):
    """A third of all rows are one vector: their cell is dealt over shards, and its queries over blocks."""
    monkeypatch.setattr(ann, "SHARD", 60)
    monkeypatch.setattr(ann, "BLOCK", 5)
    rng = np.random.default_rng(15)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)]
    data = frame(spark, rows)
    cells = ann._fit(data.selectExpr("vec_id as id", "cast(embedding as array<double>) as vec", "size(embedding) as dim"), {4: 900})[4]
    assert max(cells.shards) > 1 and len(cells.shards) > 4
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(data, data.where("vec_id % 30 = 0"), k=4, confidence=0.9999).collect())
    assert got == exact([(i, np.array(v, "float32")) for i, v in rows], [(i, np.array(v, "float32")) for i, v in rows if i % 30 == 0], 4)


def test_cells_hold_every_place_within_reach():
    rng = np.random.default_rng(16)
    points = rng.normal(size=(2000, ann.DIMS))
    cells = ann.Cells(points, 2000, 100)
    homes = cells.home(points)
    assert np.bincount(homes).max() <= 100 and len(cells.shards) == len(set(homes.tolist()))
    for q in rng.normal(size=(30, ann.DIMS)):
        away = ((points - q) ** 2).sum(1)
        for bound in (0.5, 3.0, 9.0):
            assert set(homes[away <= bound].tolist()) <= set(cells.within(q, bound))
        assert cells.within(q, math.inf) == list(range(len(cells.shards)))


def test_ties_copies_and_bad_vectors(spark):
    same, nan, inf = [1.0, 2.0, 3.0], [math.nan, 1.0, 0.0], [math.inf, 0.0, 0.0]
    rows = [(i, same) for i in range(300)] + [(300, None), (301, [0.0, 0.0, 0.0]), (302, nan), (303, inf), (304, [1.0, None, 2.0]), (305, [1.0, 2.0]), (None, same), (306, []), (400, [9.0, 9.0, 9.0])]
    data = frame(spark, rows)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(data, data.where("vec_id in (0, 5, 300, 301, 302, 303, 304, 305, 306)"), k=3).collect())
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 0.0), (5, 1, 0, 0.0), (5, 2, 1, 0.0), (5, 3, 2, 0.0)]


def test_repeated_query_rows(spark):
    rows = [(i, [1.0 + i, 2.0]) for i in range(1, 9)]
    data = frame(spark, [(0, [1.0, 2.0])] * 5 + rows)
    assert [(r["rank"], r["vec_id"]) for r in sorted(ann.search(data, data.where("vec_id = 0"), k=6).collect())] == [(n, n) for n in range(1, 7)]


def test_fewer_candidates_than_asked(spark):
    data = frame(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])])
    assert [(r["query_id"], r["vec_id"]) for r in ann.search(data, data.where("vec_id = 0")).collect()] == [(0, 1)]
    assert ann.search(data.limit(0), data.limit(0)).collect() == []


def test_the_kth_distance_stops_the_search(monkeypatch):
    """A copy of the query is no bound while k - 1 rows are near by projection only, wherever it stands among them."""
    monkeypatch.setattr(ann, "directions", lambda size: np.eye(size, ann.DIMS))
    q = np.zeros((1, ann.DIMS + 1))
    for seed in range(40):
        rng = np.random.default_rng(seed)
        near = np.hstack([rng.normal(size=(600, ann.DIMS)), np.zeros((600, 1))])
        near[:, :-1] += 4
        decoys = np.hstack([rng.normal(size=(4, ann.DIMS)) * 0.01, np.full((4, 1), 100.0)])
        rows = rng.permutation(np.vstack([near, decoys, q]))
        _, _, found = ann.search_shard(np.arange(len(rows)), rows, np.array([-1]), q, 5)
        assert max(found) < 20, seed


def test_chi_square():
    assert ann.chi2_cdf(ann.chi2_inverse(0.95)) == pytest.approx(0.95)
    draws = (np.random.default_rng(0).normal(size=(200_000, ann.DIMS)) ** 2).sum(1)
    assert (draws < ann.chi2_inverse(0.9)).mean() == pytest.approx(0.9, abs=0.005)


def test_tree_holds_every_point_once():
    points = np.random.default_rng(1).normal(size=(1000, 3))
    tree = ann.KdTree(points, 10)
    assert sorted(tree.order) == list(range(1000)) and np.diff(tree.starts).max() <= 10
    q = np.zeros(3)
    reach = tree.leaf_distances(q)
    for i in range(len(reach)):
        own = tree.points[tree.starts[i] : tree.starts[i + 1]]
        assert reach[i] <= ((own - q) ** 2).sum(1).min() + 1e-12
