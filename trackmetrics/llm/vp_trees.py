"""Nearest neighbours by Euclidean distance: vantage-point trees per shard.

1. A routing tree, fitted on a bounded sample (``SAMPLE_ROWS``), sends every row to a shard: at each node the nearer half of the sample
   goes left, by distance to a vantage point of the sample.  Shards beyond ``SHARD_ROWS`` are cut further by a hash, so a task never
   holds more.  For each shard the least and greatest distance of its rows to the vantage points on its path are kept.
2. Each shard is built into a vantage-point tree over all its rows, stored as one row of the index.  A child keeps the least
   and greatest distance of its points to the vantage point of its parent.
3. A query first searches its own shard, which gives a bound t on the distance of its k-th neighbour, and then the other shards whose
   rows may lie nearer.  By the triangle inequality a point x under a vantage point v is at least max(d(q, v) - greatest, least - d(q, v)) from q;
   a shard or a child is left out when this exceeds ``factor`` times t.  Factor 1 is exact search; a smaller
   factor leaves out more, and what is found stays ranked by exact distances.
4. The k best of all shards are ranked by (distance, id).  Distances are summed in order of the components, in double precision.

Only vectors of equal length are compared.  Null and zero vectors, those with null or non-finite components and rows without id take no part; of rows that
repeat an id the smallest vector counts.  Of equal vectors the k + 1 smallest ids are indexed: no other can be among k neighbours
(one may be the query's own).  Ties go to the smaller id; with fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.llm.common import record_batch
from trackmetrics.session import materialise

NEIGHBOURS = 10
FACTOR = 1.0
#: Rows the routing tree is fitted on for each vector length, rows of a shard, queries searched in a shard at a time, points of a leaf.
SAMPLE_ROWS = 16_384
SHARD_ROWS = 8_192
QUERY_ROWS = 2_048
LEAF_ROWS = 48
#: Relative rounding error allowed for in bounds.
SLACK = 1e-9


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of every row of a to every row of b; squares are added in order of the components."""
    total = np.zeros((len(a), len(b)))
    left, right = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    for x, y in zip(left, right):
        step = x[:, None] - y[None, :]
        step *= step
        total += step
    return np.sqrt(total, out=total)


def pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each row of a to the same row of b, added in the same order."""
    total = np.zeros(len(a))
    for x, y in zip(np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)):
        step = x - y
        total += step * step
    return np.sqrt(total, out=total)


def beyond(least: np.ndarray, greatest: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Least possible distance to points that are ``least`` to ``greatest`` from a vantage point at distance d, less rounding errors."""
    return np.maximum(d - greatest, least - d) - SLACK * (d + greatest)


class Router:
    """Binary tree in heap order: vantage point and radius per inner node, leaves are shards."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        inner = (1 << depth) - 1
        self.points, self.radius = np.zeros((inner, points.shape[1])), np.zeros(inner)
        stack = [(0, points)]
        while stack:
            node, own = stack.pop()
            if node >= inner:
                continue
            if not len(own):
                own = points[:1]
            d = distances(own[:1], own)[0]
            # The point farthest from an arbitrary one stands at the rim, where distances vary most.
            self.points[node] = own[int(np.argmax(d))]
            d = distances(self.points[node : node + 1], own)[0]
            self.radius[node] = np.median(d)
            near = d <= self.radius[node]
            stack += [(2 * node + 1, own[near]), (2 * node + 2, own[~near])]

    def route(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each row, and its distances to the vantage points on the way there."""
        node, path = np.zeros(len(rows), dtype=np.int64), np.zeros((len(rows), self.depth))
        for step in range(self.depth):
            for own in np.unique(node):
                some = np.flatnonzero(node == own)
                path[some, step] = distances(rows[some], self.points[own : own + 1])[:, 0]
            node = 2 * node + np.where(path[:, step] <= self.radius[node], 1, 2)
        return node - (1 << self.depth) + 1, path

    def way(self, shard: int) -> list[int]:
        """Inner nodes above a shard, from the root down."""
        node, out = shard + (1 << self.depth) - 1, []
        while node:
            node = (node - 1) // 2
            out.append(node)
        return out[::-1]


def build(ids: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
    """Vantage-point tree as arrays: points in leaf order, and per node its vantage point, its part of the points, its children and their distance ranges.

    Each node is split in halves by distance, so equal distances cannot make it deep.
    """
    order = np.argsort(ids, kind="stable")
    vantage, part, child, ranges = [], [], [], []

    def grow(a: int, b: int) -> int:
        node = len(part)
        part.append((a, b)), vantage.append(-1), child.append((-1, -1)), ranges.append((0.0, 0.0, 0.0, 0.0))
        if b - a > LEAF_ROWS:
            own = order[a:b]
            far = own[int(np.argmax(distances(points[own[:1]], points[own])[0]))]
            d = distances(points[far : far + 1], points[own])[0]
            by = np.argsort(d, kind="stable")
            order[a:b], d, half = own[by], d[by], (b - a) // 2
            vantage[node], ranges[node] = int(far), (d[0], d[half - 1], d[half], d[-1])
            child[node] = (grow(a, a + half), grow(a + half, b))
        return node

    grow(0, len(ids))
    place = np.empty(len(ids), dtype=np.int64)
    place[order] = np.arange(len(ids))
    used = np.array(vantage)
    return {
        "ids": ids[order], "points": points[order], "vantage": np.where(used >= 0, place[used], -1), "part": np.array(part), "child": np.array(child), "ranges": np.array(ranges),
    }


class Best:
    """The k nearest of each query so far, by (distance, id); places without a neighbour hold the id ``NONE``."""

    NONE = np.iinfo(np.int64).max

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, bound: np.ndarray):
        self.own, self.queries, self.bound = ids, queries, bound
        self.square = (queries * queries).sum(axis=1)
        self.d, self.id = np.full((len(ids), k), np.inf), np.full((len(ids), k), self.NONE)

    def limit(self) -> np.ndarray:
        """Distance of the k-th neighbour, or the bound known before if that is nearer."""
        return np.minimum(self.d[:, -1], self.bound)

    def add(self, rows: np.ndarray, points: np.ndarray, ids: np.ndarray) -> None:
        """Products tell which pairs may be near enough, up to rounding; those are measured exactly."""
        square, limit = (points * points).sum(axis=1), self.limit()[rows]
        size = self.square[rows][:, None] + square[None, :]
        far = size - 2 * (self.queries[rows] @ points.T) > limit[:, None] ** 2 + SLACK * size
        x, y = np.nonzero(~(far | (self.own[rows][:, None] == ids[None, :])))
        if not len(x):
            return
        some, x = np.unique(x, return_inverse=True)
        rows = rows[some]
        d, own = np.full((len(rows), len(ids)), np.inf), np.full((len(rows), len(ids)), self.NONE)
        d[x, y], own[x, y] = pair_distances(self.queries[rows[x]], points[y]), ids[y]
        d, own = np.concatenate([self.d[rows], d], axis=1), np.concatenate([self.id[rows], own], axis=1)
        by = np.lexsort((own, d), axis=-1)[:, : self.d.shape[1]]
        self.d[rows], self.id[rows] = np.take_along_axis(d, by, 1), np.take_along_axis(own, by, 1)


def search(tree: dict[str, np.ndarray], best: Best, factor: float) -> int:
    """Add what the tree holds to ``best``; the number of pairs looked at.

    Every query first goes down to one leaf, which bounds the distance of its neighbours; then each node is visited once, with all
    queries that may still find something there.
    """
    points, ids, made = tree["points"], tree["ids"], 0
    home = np.full(len(best.own), -1)

    def gaps(node: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nonlocal made
        made += len(rows)
        d = distances(best.queries[rows], points[tree["vantage"][node]][None, :])[:, 0]
        low_in, high_in, low_out, high_out = tree["ranges"][node]
        return beyond(low_in, high_in, d), beyond(low_out, high_out, d)

    def leaf(node: int, rows: np.ndarray) -> None:
        nonlocal made
        a, b = tree["part"][node]
        made += len(rows) * int(b - a)
        for k in range(0, len(rows), 1024):
            best.add(rows[k : k + 1024], points[a:b], ids[a:b])

    def descend(node: int, rows: np.ndarray) -> None:
        if tree["vantage"][node] < 0:
            home[rows] = node
            leaf(node, rows)
            return
        gap = gaps(node, rows)
        for side, some in enumerate((gap[0] <= gap[1], ~(gap[0] <= gap[1]))):
            if some.any():
                descend(int(tree["child"][node][side]), rows[some])

    def visit(node: int, rows: np.ndarray) -> None:
        if tree["vantage"][node] < 0:
            leaf(node, rows[home[rows] != node])
            return
        for side, gap in enumerate(gaps(node, rows)):
            some = ~(gap > factor * best.limit()[rows])
            if some.any():
                visit(int(tree["child"][node][side]), rows[some])

    descend(0, np.arange(len(best.own)))
    visit(0, np.arange(len(best.own)))
    return made


_TREE = {"ids": "<i8", "points": "<f8", "vantage": "<i8", "part": "<i8", "child": "<i8", "ranges": "<f8"}


def _packed(tree: dict[str, np.ndarray]) -> dict[str, bytes]:
    return {k: tree[k].astype(kind).tobytes() for k, kind in _TREE.items()}


def _unpacked(row: dict) -> dict[str, np.ndarray]:
    tree = {k: np.frombuffer(row[k], dtype=kind) for k, kind in _TREE.items()}
    n = len(tree["ids"])
    return tree | {"points": tree["points"].reshape(n, -1), "part": tree["part"].reshape(-1, 2), "child": tree["child"].reshape(-1, 2), "ranges": tree["ranges"].reshape(-1, 4)}


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per id with a vector that takes part: vec_id, dim, v."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").where(finite & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", F.size("v").alias("dim"), "v")


def routers(points: DataFrame, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS) -> dict[int, Router]:
    """A routing tree per vector length that needs more than one shard, fitted on about ``sample_rows`` rows in all."""
    sizes = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows).collect()}
    total = sum(sizes.values())
    if not total:
        return {}
    share = min(1.0, sample_rows / total)
    picked = points.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).where(F.col("dim").isin(list(sizes)))
    held: dict[int, list] = {}
    for r in picked.select("dim", "vec_id", "v").sort("vec_id").toLocalIterator():
        held.setdefault(r["dim"], []).append(r["v"])
    out = {}
    for dim, rows in held.items():
        # A shard of the sample has 8 rows at least; further rows are dealt by hash.
        depth = min(math.ceil(math.log2(sizes[dim] / shard_rows)), int(math.log2(max(2, len(rows) // 8))))
        out[dim] = Router(np.array(rows, dtype=np.float64), max(1, depth))
    return out


def _routed(points: DataFrame, known) -> DataFrame:
    """Rows vec_id, dim, v with shard and path."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("v", pa.list_(pa.float64())), ("shard", pa.int64()), ("path", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                shard, path = np.zeros(len(part), np.int64), [[]] * len(part)
                if dim in known.value:
                    shard, path = known.value[dim].route(_matrix(part.column("v")))
                    path = path.tolist()
                yield record_batch({"vec_id": part.column("vec_id"), "dim": part.column("dim"), "v": part.column("v"), "shard": shard, "path": path}, schema)

    return points.mapInArrow(run, "vec_id long, dim int, v array<double>, shard long, path array<double>")


_KEY = ["dim", "shard", "sub"]


def index(points: DataFrame, known, k: int = NEIGHBOURS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stored index: one row per shard part with its tree, and the range of its distances to each vantage point on its way (low, high)."""
    fields = [*[(c, pa.int64()) for c in ("dim", "shard", "sub")], ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), *[(c, pa.binary()) for c in _TREE]]
    schema = pa.schema(fields)

    def grown(key, table):
        tree = build(table.column("vec_id").to_numpy(), _matrix(table.column("v")))
        path = _matrix(table.column("path"))
        row = dict(zip(_KEY, (x.as_py() for x in key))) | {"low": path.min(axis=0).tolist(), "high": path.max(axis=0).tolist()} | _packed(tree)
        return pa.table({c: [row[c]] for c in schema.names}, schema=schema)

    # Copies of a vector: only the k + 1 smallest ids can be among the k nearest of anything.
    copies = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    rows = points.withColumn("copy", copies).where(F.col("copy") <= k + 1).select("vec_id", "dim", "v")
    routed = materialise(_routed(rows, known), "routed")
    parts = routed.groupBy("dim", "shard").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("parts"))
    dealt = routed.join(F.broadcast(parts), ["dim", "shard"]).withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    columns = "dim long, shard long, sub long, low array<double>, high array<double>, " + ", ".join(f"{c} binary" for c in _TREE)
    return materialise(dealt.select("vec_id", F.col("dim").cast("long").alias("dim"), "shard", "sub", "v", "path").groupBy(*_KEY).applyInArrow(grown, columns), "vp_trees")


def _searched(trees: DataFrame, visits: DataFrame, k: int, factor: float, query_rows: int) -> DataFrame:
    """Rows query_id, vec_id, score: up to k per query and shard part visited; ``visits`` has query_id, q, bound and the key of the part."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    # A part that very many queries visit is searched block by block of them.
    visits = materialise(visits, "visits")
    blocks = visits.groupBy(*_KEY).agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("blocks"))
    dealt = visits.join(blocks, _KEY).withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks"))).drop("blocks")
    wanted = trees.join(blocks, _KEY).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks", "low", "high")

    def run(key, left, right):
        out: dict[str, list] = {c: [np.zeros(0)] for c in schema.names}
        ids = left.column("query_id").to_numpy()
        if len(ids) and right.num_rows:
            tree = _unpacked(right.to_pylist()[0])
            best = Best(ids, _matrix(left.column("q")), k, left.column("bound").to_numpy())
            search(tree, best, factor)
            row, rank = np.nonzero(best.id != Best.NONE)
            out = {"query_id": [ids[row]], "vec_id": [best.id[row, rank]], "score": [best.d[row, rank]]}
        return pa.table([pa.array(np.concatenate(out[f.name]), f.type) for f in schema], schema=schema)

    keys = [*_KEY, "block"]
    return dealt.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def nearest(embeddings: DataFrame, queries: Column | None = None, k: int = NEIGHBOURS, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding",
            sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Rows query_id, rank, vec_id, score: the k nearest other vectors of each row that ``queries`` (a condition on vec_id) holds for."""
    spark = embeddings.sparkSession
    points = materialise(usable(embeddings, id_col, vector_col), "points")
    fitted = routers(points, sample_rows, shard_rows)
    known = spark.sparkContext.broadcast(fitted)
    trees = index(points, known, k, shard_rows)
    asked = points.where(F.pmod("vec_id", F.lit(100)) == 0 if queries is None else queries)
    asked = materialise(_routed(asked, known), "queries").withColumn("dim", F.col("dim").cast("long"))

    # First the own shard, which may be in several parts.
    parts = trees.select(*_KEY, "low", "high")
    home = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.lit(math.inf).alias("bound"), "dim", "shard").join(parts.drop("low", "high"), ["dim", "shard"])
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    first = materialise(_searched(trees, home, k, factor, query_rows), "own_shard").withColumn("rank", ranked).where(F.col("rank") <= k)
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    other = asked.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(math.inf)))
    more = _searched(trees, _other_shards(other, parts, known, factor), k, factor, query_rows)
    every = first.drop("rank").unionByName(more).withColumn("rank", ranked).where(F.col("rank") <= k)
    return every.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _other_shards(asked: DataFrame, parts: DataFrame, known, factor: float) -> DataFrame:
    """Visits of each query to the parts of other shards that may hold something nearer than its bound."""
    ranges: dict[int, list] = {}
    for r in parts.collect():  # a few numbers per part of an index row of several MB
        ranges.setdefault(r["dim"], []).append((r["shard"], r["sub"], r["low"], r["high"]))
    shared = asked.sparkSession.sparkContext.broadcast(ranges)
    schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("bound", pa.float64()), *[(c, pa.int64()) for c in _KEY]])

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in known.value:
                    continue
                part, router = batch.filter(pa.array(dims == dim)), known.value[dim]
                rows, own, bound = _matrix(part.column("v")), part.column("shard").to_numpy(), part.column("bound").to_numpy()
                away = distances(rows, router.points)
                for shard, sub, low, high in shared.value[dim]:
                    d = away[:, router.way(shard)]
                    gap = beyond(np.array(low)[None, :], np.array(high)[None, :], d).max(axis=1)
                    go = pa.array(np.flatnonzero(~(gap > factor * bound) & (own != shard)))
                    if len(go):
                        some, n = part.take(go), len(go)
                        yield record_batch({"query_id": some.column("vec_id"), "q": some.column("v"), "bound": some.column("bound"), "dim": [dim] * n, "shard": [shard] * n, "sub": [sub] * n}, schema)

    return asked.select("vec_id", "dim", "v", "shard", "bound").mapInArrow(run, "query_id long, q array<double>, bound double, dim long, shard long, sub long")
