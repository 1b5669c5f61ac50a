"""Vantage-point trees against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmetrics.llm import vp_trees


def slow(rows, k=10, every=100):
    """(query_id, rank, vec_id, score) by comparing all pairs."""
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = min(usable.get(i, v), v)
    out = set()
    for q, a in usable.items():
        if q % every:
            continue
        found = []
        for i, b in usable.items():
            if i != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += (x - y) * (x - y)
                found.append((math.sqrt(total), i))
        out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(sorted(found)[:k])}
    return out


def frame(spark, rows):
    clash = {c: F.lit("x") for c in ("dim", "v", "shard", "path", "sub", "rank", "score", "query_id", "bound", "q", "block", "ids", "points")}
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(clash).repartition(3)


def clustered(n, dim, seed, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return (centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))).tolist()


@pytest.mark.parametrize("shard_rows, query_rows", [(8_192, 2_048), (100, 3)])
def test_exact_search(spark, shard_rows, query_rows):
    rows = list(enumerate(clustered(1_500, 6, 1)))
    rows += [(2_000 + i, rows[7][1]) for i in range(40)] + [(-100, rows[7][1]), (-300, [0.5] * 6)]
    found = vp_trees.nearest(frame(spark, rows), shard_rows=shard_rows, query_rows=query_rows, sample_rows=400).collect()
    assert {tuple(r) for r in found} == slow(rows) and len(found) == len(slow(rows))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]),
        (8, [1.0, 0.0, 0.0]), (100, [-0.0, 1.0]), (100, [5.0, 5.0]), (200, [0.0, 1.0]), (300, [3.0]), (400, [0.0, 0.0]), (9, [1e200, -1e200]), (10, [-1e200, 1e200]), (-200, [1e-300, 0.0]),
    ]
    got = [tuple(r) for r in vp_trees.nearest(frame(spark, rows)).collect()]
    expected = slow(rows)
    assert set(got) == expected and len(got) == len(expected) and {r[0] for r in got} == {0, 100, 200, -200}
    assert vp_trees.nearest(frame(spark, rows).where("vec_id > 1000000")).count() == 0


def test_hot_copies(spark):
    """A third of all rows are one vector, one more third lies at equal distances from everything."""
    rng = random.Random(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(600)]
    rows += [(600 + i, [float(i == k) for k in range(4)]) for i in range(4)] + [(1_000 + i, [rng.random() for _ in range(4)]) for i in range(600)]
    got = vp_trees.nearest(frame(spark, rows), shard_rows=128, sample_rows=300, query_rows=4).collect()
    assert {tuple(r) for r in got} == slow(rows)


def test_factor_prunes_and_recall():
    rng = np.random.default_rng(8)
    points = np.array(clustered(4_000, 8, 2, 0.1))
    ids, queries = np.arange(4_000), rng.choice(4_000, 100, replace=False)
    tree = vp_trees.build(ids, points)
    sets, looked = {}, {}
    for factor in (1.0, 0.6, 0.3):
        best = vp_trees.Best(ids[queries], points[queries], 10, np.full(100, np.inf))
        looked[factor] = vp_trees.search(tree, best, factor)
        sets[factor] = [set(r) for r in best.id.tolist()]
    away = vp_trees.distances(points[queries], points)
    away[np.arange(100), queries] = np.inf
    truth = [set(np.lexsort((ids, d))[:10].tolist()) for d in away]
    recall = {f: np.mean([len(a & b) / 10 for a, b in zip(s, truth)]) for f, s in sets.items()}
    assert recall[1.0] == 1 and recall[0.6] >= 0.9
    assert looked[0.3] < looked[0.6] < looked[1.0] < 0.5 * 100 * 4_000


def test_tree_holds_every_point_once():
    points = np.array(clustered(500, 3, 5) + [[1.0, 1.0, 1.0]] * 300)
    tree = vp_trees.build(np.arange(800)[::-1].copy(), points)
    assert sorted(tree["ids"].tolist()) == list(range(800)) and np.array_equal(tree["points"], points[799 - tree["ids"]])
    leaves = [tuple(p) for p, v in zip(tree["part"].tolist(), tree["vantage"].tolist()) if v < 0]
    assert sorted(leaves)[0][0] == 0 and all(a[1] == b[0] for a, b in zip(sorted(leaves), sorted(leaves)[1:])) and max(b - a for a, b in leaves) <= vp_trees.LEAF_ROWS
