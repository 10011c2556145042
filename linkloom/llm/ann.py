"""Nearest neighbours by low-dimensional stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected on ``DIMS`` random normal directions. For a pair at distance d, the
squared projected distance over d^2 follows a chi-square law with ``DIMS`` degrees of freedom.
The top levels of the kd-tree over the projections are fitted on a hash sample of about
``SAMPLE`` rows and cut the space into cells of about ``SHARD`` rows; every row is indexed in its
cell, by a tree of its own. A query opens the leaves of a cell by growing distance, verifies
points in order of projected distance with the original vectors, and stops when a point as near
as the current k-th would, with probability ``CONFIDENCE``, have shown up already. It starts in
the cell it falls in, and then goes only to the cells whose box passes the same test at the k-th
distance found there. A cell of many equal projections is dealt over several shards, one that
many queries go to is sent to several blocks of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.storage import materialize

DIMS = 8
CONFIDENCE = 0.95
LEAF = 32
SHARD = 16_384
BLOCK = 2_048
SAMPLE = 65_536
SEED = 7


def chi2_cdf(x: float, dims: int = DIMS) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(dims // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def chi2_inverse(p: float, dims: int = DIMS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, dims) < p else (low, middle)
    return high


def directions(size: int, dims: int = DIMS) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, dims))


class KdTree:
    """Leaves of at most ``leaf`` points with their boxes; points are kept in leaf order."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        stack, order, starts = [np.arange(len(points))], [], [0]
        while stack:
            own = stack.pop()
            spread = np.ptp(points[own], axis=0)
            if len(own) <= leaf or not spread.any():
                order.append(own)
                starts.append(starts[-1] + len(own))
                continue
            half = len(own) // 2
            split = np.argpartition(points[own, spread.argmax()], half)
            stack += [own[split[half:]], own[split[:half]]]
        self.order = np.concatenate(order)
        self.starts = np.array(starts)
        self.points = points[self.order]
        self.low = np.minimum.reduceat(self.points, self.starts[:-1])
        self.high = np.maximum.reduceat(self.points, self.starts[:-1])

    def leaf_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of ``q`` to each leaf's box."""
        away = np.maximum(0, np.maximum(self.low - q, q - self.high))
        return np.einsum("ij,ij->i", away, away)


class Cells:
    """The top of the kd-tree: axis-parallel cuts fitted on a sample, and the shards of each cell."""

    def __init__(self, points: np.ndarray, total: int, shard: int):
        self.cuts: list[tuple[int, float, int, int]] = []  # axis, value, child below, child from it on; a leaf is -1 - its number
        self.shards: list[int] = []
        share = total / max(1, len(points))
        self.root = self._cut(points, share, shard) if len(points) else self._leaf(total, shard)

    def _leaf(self, rows: float, shard: int) -> int:
        self.shards.append(max(1, math.ceil(rows / (2 * shard))))
        return -len(self.shards)

    def _cut(self, points: np.ndarray, share: float, shard: int) -> int:
        if len(points) * share <= shard or len(points) < 2:
            return self._leaf(len(points) * share, shard)
        axis = int(np.ptp(points, axis=0).argmax())
        value = float(np.median(points[:, axis]))
        below = points[:, axis] < value
        if not below.any():
            above = points[points[:, axis] > value, axis]
            if not len(above):
                return self._leaf(len(points) * share, shard)
            value = float(above.min())
            below = points[:, axis] < value
        at = len(self.cuts)
        self.cuts.append((axis, value, 0, 0))
        self.cuts[at] = (axis, value, self._cut(points[below], share, shard), self._cut(points[~below], share, shard))
        return at

    def home(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.empty(len(points), np.int32)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, own = stack.pop()
            if node < 0:
                out[own] = -1 - node
            elif len(own):
                axis, value, low, high = self.cuts[node]
                below = points[own, axis] < value
                stack += [(low, own[below]), (high, own[~below])]
        return out

    def within(self, point: np.ndarray, bound: float) -> list[int]:
        """The cells whose box is at a squared distance of at most ``bound``."""
        out, stack = [], [(self.root, 0.0, {})]
        while stack:
            node, reach, away = stack.pop()
            if node < 0:
                out.append(-1 - node)
                continue
            axis, value, low, high = self.cuts[node]
            gap = float(point[axis]) - value
            near, far = (low, high) if gap < 0 else (high, low)
            stack.append((near, reach, away))
            more = reach - away.get(axis, 0.0) + max(away.get(axis, 0.0), gap * gap)
            if more <= bound:
                stack.append((far, more, {**away, axis: max(away.get(axis, 0.0), gap * gap)}))
        return sorted(out)


def project(vectors: np.ndarray) -> np.ndarray:
    """Made row by row alike for data and queries, so that equal vectors meet exactly."""
    return np.einsum("ij,jk->ik", vectors, directions(vectors.shape[1]))


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, confidence: float = CONFIDENCE, known: np.ndarray | None = None, names: np.ndarray | None = None) -> tuple[list, list, list]:
    """(query, neighbour, distance) lists: up to k of one shard for each query, with its id or its entry of ``names``.

    ``known`` bounds the k-th distances from elsewhere.
    """
    tree = KdTree(project(vectors))
    places = project(queries)
    known = np.full(len(queries), math.inf) if known is None else known
    names = query_ids if names is None else names
    vectors, ids = vectors[tree.order], ids[tree.order]
    limit = chi2_inverse(confidence)
    out: tuple[list, list, list] = ([], [], [])
    for qid, name, q, place, top in zip(query_ids.tolist(), names.tolist(), queries, places, known.tolist(), strict=True):
        reach = tree.leaf_distances(place)
        leaves = np.argsort(reach, kind="stable")
        best_d, best_i = np.empty(0), np.empty(0, np.int64)
        wait_i, wait_d = np.empty(0, np.int64), np.empty(0)
        opened, step = 0, 4
        while opened < len(leaves):
            part = leaves[opened : opened + step]
            opened, step = opened + step, min(step * 2, 64)
            at = np.concatenate([np.arange(tree.starts[x], tree.starts[x + 1]) for x in part])
            gap = tree.points[at] - place
            wait_i, wait_d = np.concatenate((wait_i, at)), np.concatenate((wait_d, np.einsum("ij,ij->i", gap, gap)))
            frontier = reach[leaves[opened]] if opened < len(leaves) else math.inf
            now = wait_d <= frontier
            take = wait_i[now]
            take = take[ids[take] != qid]
            wait_i, wait_d = wait_i[~now], wait_d[~now]
            exact = np.sqrt(((vectors[take] - q) ** 2).sum(axis=1))
            best_d, best_i = np.concatenate((best_d, exact)), np.concatenate((best_i, ids[take]))
            if len(best_d) >= k:
                keep = np.lexsort((best_i, best_d))[:k]
                best_d, best_i = best_d[keep], best_i[keep]
            kth = min(top, best_d[-1] if len(best_d) == k else math.inf)
            if frontier > limit * kth**2 and frontier > 0:
                break
        out[0].extend([name] * len(best_d))
        out[1].extend(best_i.tolist())
        out[2].extend(best_d.tolist())
    return out


def _valid(vec: str) -> Column:
    """Not null, no null or non-finite component, not zero."""
    x = F.col(vec)
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)) & F.exists(x, lambda v: v != 0)


def search(data: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found of each query's row.

    ``queries`` has the same columns as ``data``. Candidates are all rows but those with the
    query's id. score is the Euclidean distance in double precision; ties go to the smaller
    id. Rows without an id and vectors that are null, zero or hold null or non-finite
    components take no part, on either side; vectors of other lengths than the query's aren't
    candidates. Repeated rows are candidates each; as queries they count once. An id queried
    with several vectors gets the k nearest rows over all of them, a row once for each vector
    it is near to. Other columns are ignored.
    """

    def clean(df: DataFrame) -> DataFrame:
        picked = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
        return picked.where(F.col("id").isNotNull() & F.coalesce(_valid("vec"), F.lit(False))).withColumn("dim", F.size("vec"))

    data, queries = clean(data), clean(queries).dropDuplicates(["id", "vec"])
    counts = {r["dim"]: r["count"] for r in data.groupBy("dim").count().collect()}  # a row per length of vector
    cells = _fit(data, counts)
    block, limit, found = BLOCK, chi2_inverse(confidence), None
    homes = _routed(queries, cells, "home", limit)
    placed = _routed(data, cells, "row", limit)
    for asked in (homes, None):
        if asked is None:
            kth = F.row_number().over(Window.partitionBy("query_id", "query_no").orderBy("score"))
            radius = found.withColumn("n", kth).where(F.col("n") == k).select(F.col("query_id").alias("id"), "query_no", F.col("score").alias("radius"))
            known = queries.withColumn("query_no", F.xxhash64("vec")).join(radius, ["id", "query_no"], "left")
            asked = _routed(known, cells, "rest", limit)
        asked = materialize(asked, "asked")
        near = _near(placed, asked, k, confidence, block)
        near = materialize(near, "near")
        found = near if found is None else found.unionByName(near)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy().reshape(-1, dim)


def _projected(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, projections) of the rows of a batch with vec and dim."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, project(_matrix(batch.column("vec").take(pa.array(at)), dim))


def _fit(data: DataFrame, counts: dict[int, int]) -> dict[int, Cells]:
    """The cells of the vectors of each length, fitted on about ``SAMPLE`` projections."""
    share = min(1.0, SAMPLE / max(1, sum(counts.values())))
    picked = data if share == 1.0 else data.where(F.pmod(F.xxhash64("id", "vec", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, points in _projected(batch):
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(at), pa.int32()), pa.array(list(points), pa.list_(pa.float64()))], ["dim", "point"])

    sampled: dict[int, list] = {}
    if sum(counts.values()) > SHARD:
        for row in picked.select("vec", "dim").mapInArrow(run, "dim int, point array<double>").collect():
            sampled.setdefault(row["dim"], []).append(row["point"])
    return {dim: Cells(np.array(sorted(sampled.get(dim, []))).reshape(-1, DIMS), n, SHARD) for dim, n in counts.items()}


def _routed(rows: DataFrame, cells: dict[int, Cells], kind: str, limit: float) -> DataFrame:
    """The rows with cell and shard. row: its shard; home: a query in all shards of its own cell; rest: in the other cells within reach of radius."""
    names = [c for c in rows.columns]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, cell, shard = [], [], []
            salt = batch.column("salt").to_numpy()
            for dim, at, points in _projected(batch):
                own = cells.get(dim)
                if own is None:
                    continue
                homes = own.home(points)
                for i, point, home in zip(at.tolist(), points, homes.tolist(), strict=True):
                    if kind == "row":
                        places = [(home, int(salt[i]) % own.shards[home])]
                    elif kind == "home":
                        places = [(home, x) for x in range(own.shards[home])]
                    else:
                        radius = batch.column("radius")[i].as_py()
                        reach = math.inf if radius is None else limit * radius**2
                        places = [(c, x) for c in own.within(point, reach) if c != home for x in range(own.shards[c])]
                    for c, x in places:
                        take.append(i)
                        cell.append(c)
                        shard.append(x)
            part = batch.select(names).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int32()), pa.array(shard, pa.int32())], [*names, "cell", "shard"])

    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "vec"), F.lit(1 << 30)))
    fields = rows.schema.fields + [T.StructField("cell", T.IntegerType()), T.StructField("shard", T.IntegerType())]
    return salted.mapInArrow(run, T.StructType(fields))


def _near(placed: DataFrame, asked: DataFrame, k: int, confidence: float, block: int) -> DataFrame:
    """query_id, query_no, vec_id, score: up to k rows for each query and shard that it goes to."""
    keys = ["dim", "cell", "shard"]
    blocks = materialize(asked.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "blocks")
    left = placed.join(blocks, keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    radius = F.col("radius") if "radius" in asked.columns else F.lit(None).cast("double")
    right = asked.join(blocks, keys).withColumn("block", F.pmod(F.xxhash64("id", "vec"), F.col("blocks")).cast("int"))
    right = right.select("id", "vec", *keys, "block", radius.alias("radius"), F.xxhash64("vec").alias("query_no"))

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        numbers: list[int] = []
        if rows.num_rows and asked.num_rows:
            dim = rows.column("dim")[0].as_py()
            known = asked.column("radius").to_pandas().fillna(math.inf).to_numpy(float)
            place = np.arange(asked.num_rows)
            ids = asked.column("id").to_numpy()
            found = search_shard(rows.column("id").to_numpy(), _matrix(rows.column("vec"), dim), ids, _matrix(asked.column("vec"), dim), k, confidence, known, place)
            numbers = asked.column("query_no").to_numpy()[found[0]].tolist()
            found = (ids[found[0]].tolist(), found[1], found[2])
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "query_no": pa.array(numbers, pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    by = [*keys, "block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, "query_id long, query_no long, vec_id long, score double")


def recall(found: DataFrame, exact: DataFrame, k: int = 10) -> float:
    """Share of the exact neighbours (same columns) that were found."""
    hits = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    total = exact.where(F.col("rank") <= k).count()
    return hits / total if total else 1.0
