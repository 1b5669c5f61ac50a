"""Boosted trees against exhaustive search, Shapley values against the sum over all sets of features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmetrics.operators import boosting as B

SETTING = (0.1, 6, 4, 12)


def sample(n=300, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[rng.random((n, 4)) < 0.1] = np.nan
    y = ((np.nan_to_num(x[:, 0], nan=-2) > 0.3) ^ (np.nan_to_num(x[:, 2], nan=-2) < -0.5)).astype(float)
    return x, y


def flat(base, trees):
    rows = [(0, -1, 0, -1, 0.0, -1, -1, base, 0.0, 0.0)] + [(0, t, i, *n) for t, nodes in enumerate(trees) for i, n in enumerate(nodes)]
    import pandas as pd

    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in B.TREES.split(", ")])
    return B.load(type("Stored", (), {"toPandas": lambda self: frame})())[0]


def members(x, nodes, node, rows, want):
    """Rows of a node by walking the tree from its root."""
    if node == want:
        return rows
    feature, threshold, below, above = nodes[node][:4]
    if feature < 0:
        return None
    high = x[rows, feature] > threshold
    for child, part in ((below, rows[~high]), (above, rows[high])):
        found = members(x, nodes, child, part, want)
        if found is not None:
            return found


def test_every_split_has_the_best_gain_of_its_leaf_and_the_best_leaf_is_cut_first():
    x, y = sample()
    _, trees = B.grow(x, y, SETTING)
    share = y.mean()
    w = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    raw = np.zeros(len(y))
    for nodes in trees:
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (p - y), w * p * (1 - p)

        def gain(rows):
            best = 0.0
            for j in range(x.shape[1]):
                for cut in np.unique(x[rows, j][~np.isnan(x[rows, j])]):
                    high = x[rows, j] > cut
                    a, b = rows[~high], rows[high]
                    if min(len(a), len(b)) >= SETTING[2] and min(h[a].sum(), h[b].sum()) >= B.MIN_CURVATURE:
                        best = max(best, g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum())
            return best

        everything = np.arange(len(y))
        inner = [i for i, n in enumerate(nodes) if n[0] >= 0]
        for i in inner:
            assert nodes[i][6] == pytest.approx(gain(members(x, nodes, 0, everything, i)))
        # Children are numbered when their parent is cut: of the leaves open then, it had the largest gain.
        for i in sorted(inner, key=lambda i: nodes[i][2]):
            alive = [k for k in range(nodes[i][2]) if nodes[k][0] < 0 or nodes[k][2] >= nodes[i][2]]
            assert nodes[i][6] >= max(gain(members(x, nodes, 0, everything, k)) for k in alive) - 1e-9
        assert sum(n[0] < 0 for n in nodes) <= SETTING[1]
        for i, n in enumerate(nodes):
            if n[0] < 0:
                rows = members(x, nodes, 0, everything, i)
                assert len(rows) == n[5] >= SETTING[2]
                raw[rows] += n[4]
    assert B.raw_scores(flat(0.0, trees), x) == pytest.approx(raw)


def test_contributions_are_the_shapley_values_of_the_trees():
    x, y = sample(n=200, seed=9)
    base, trees = B.grow(x, y, (0.2, 8, 5, 4))
    model = flat(base, trees)
    leaves = B.paths(model)
    rows = x[:25]

    def known(row, features, node):
        feature = model.feature[node]
        if feature < 0:
            return model.value[node]
        below, above = model.below[node], model.above[node]
        if feature in features:
            return known(row, features, above if row[feature] > model.threshold[node] else below)
        return sum(model.cover[c] / model.cover[node] * known(row, features, c) for c in (below, above))

    value = lambda row, s: model.base + sum(known(row, s, r) for r in model.roots)
    found = B.contributions(leaves, rows)
    for row, got in zip(rows, found):
        for i in range(4):
            others = [j for j in range(4) if j != i]
            want = sum(
                factorial(k) * factorial(3 - k) / 24 * (value(row, {*s, i}) - value(row, set(s)))
                for k in range(4) for s in combinations(others, k))
            assert got[i] == pytest.approx(want, abs=1e-12)
    assert B.expected(model, leaves) + found.sum(axis=1) == pytest.approx(B.raw_scores(model, rows))


def test_models_side_by_side_learn_only_from_their_rows(spark):
    x, y = sample(n=400)
    rows = [(i, int(y[i]), int(i % 2), *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(400)]
    rows += [(400, None, 0, 1.0, 1.0, 1.0, 1.0)]  # no label: not learned from, but scored
    df = spark.createDataFrame(rows, "id int, y int, side int, a double, b double, c double, d double")
    tasks = {0: B.Task(SETTING, F.col("side") == 0), 1: B.Task(SETTING, F.col("side") == 1), 2: B.Task((0.1, 3, 5, 2), F.lit(True))}
    for partitions in (1, 7):
        models = B.load(B.fit(df.repartition(partitions), ["a", "b", "c", "d"], "y", "id", tasks))
        for side in (0, 1):
            own = np.array(sorted((str(i) for i in range(400) if i % 2 == side))).astype(int)
            base, trees = B.grow(x[own], y[own], SETTING)
            assert B.raw_scores(models[side], x) == pytest.approx(B.raw_scores(flat(base, trees), x))
        assert len(models[2].roots) == 2
    scored = B.score(df, ["a", "b", "c", "d"], models[0]).collect()
    assert len(scored) == 401 and all(0 < r["score"] < 1 for r in scored)
    told = B.explain(df, ["a", "b", "c", "d"], models[0]).collect()
    assert all(sum(r["shap"]) + r["base"] == pytest.approx(r["raw"]) for r in told)


def test_sample_is_bounded_and_edge_cases_are_defined(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), F.col("id").cast("double").alias("a"))
    tasks = {0: B.Task((0.1, 3, 5, 1), F.lit(True))}
    base = B.fit(df, ["a"], "y", "id", tasks, limit=1000).where("tree = -1").first()
    assert 850 < base["cover"] < 1150
    empty = B.load(B.fit(df.where("id < 0"), ["a"], "y", "id", tasks))
    assert empty == {}
    assert B.score(df.limit(2), ["a"], empty.get(0)).where("score IS NOT NULL").count() == 0
    one_class = B.load(B.fit(df.where("y = 1"), ["a"], "y", "id", tasks))[0]
    assert len(one_class.roots) == 0 and B.score(df.limit(2), ["a"], one_class).agg(F.min("score")).first()[0] > 0.99
    constant = B.load(B.fit(df.withColumn("a", F.lit(1.0)), ["a"], "y", "id", tasks))[0]
    assert len(constant.roots) == 0
    nothing = B.load(B.fit(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y", "id", tasks))[0]
    assert B.score(df.limit(2), ["a"], nothing).agg(F.min("score")).first()[0] == 0.5


def test_contributions_of_more_rows_integrate_nothing_again(monkeypatch):
    """Rows look up what a leaf gives: the integrals belong to the model."""
    x, y = sample(n=200, seed=9)
    model = flat(*B.grow(x, y, (0.2, 8, 5, 4)))
    known = B.lookup(B.paths(model), x.shape[1])
    direct = B.lookup(B.paths(model), x.shape[1])._replace(leaves=[(limits, leaf, None) for limits, leaf, _ in known.leaves])
    rows = np.concatenate([x, [[np.inf] * 4, [-np.inf] * 4, [np.nan] * 4]])
    want = B.contributions(direct, rows)
    monkeypatch.setattr(np.polynomial.legendre, "leggauss", None)
    assert (B.contributions(known, rows) == want).all()
    assert B.contributions(known, rows[:0]).shape == (0, 4)


def test_scoring_holds_no_block_of_rows_times_trees():
    import tracemalloc

    x, y = sample(n=256)
    base, trees = B.grow(x, y, SETTING)
    model = flat(base, trees * 200)
    tracemalloc.start()
    scores = B.raw_scores(model, x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000
    assert scores == pytest.approx(200 * B.raw_scores(flat(base, trees), x))


def many_rows(spark, n=40_000):
    """More rows than a model once learned from (32 768)."""
    at = F.col("id")
    return spark.range(n, numPartitions=6).select(
        at.alias("track_id"), (at % 5).cast("int").alias("fold"), (at % 97 > 60).cast("int").alias("is_hit"),
        (at % 97).cast("double").alias("a"), F.when(at % 11 > 0, at % 1000).cast("double").alias("b"))


def test_a_model_learns_from_all_rows(spark):
    df = many_rows(spark)
    tasks = {3: B.Task((0.1, 3, 5, 1), F.col("fold") != 0), 1: B.Task((0.1, 3, 5, 2), F.lit(True))}
    found = {r["model"]: r["cover"] for r in B.fit(df, ["a", "b"], "is_hit", "track_id", tasks).where("tree = -1").collect()}
    assert found == {3: 32_000, 1: 40_000}


def test_shapley_query_explains_a_model_of_all_rows(spark, monkeypatch):
    from trackmetrics.operators import models as M
    from trackmetrics.plans import modelling

    explain, seen = B.explain, []
    monkeypatch.setattr(modelling, "matrix", lambda *a, **k: many_rows(spark))
    monkeypatch.setattr(modelling, "columns_of", lambda df, wanted: ["a", "b"])
    monkeypatch.setattr(M, "BOOSTING", [(0.1, 3, 5, 2)] * 8)
    monkeypatch.setattr(B, "explain", lambda df, x, model: seen.append(model) or explain(df, x, model))
    rows = modelling.shapley_ranking(None).collect()
    assert {(r["variable"], r["shap_rank"], r["within_bound"]) for r in rows} == {("a", 1, True), ("b", 2, True)}
    assert [seen[0].cover[root] for root in seen[0].roots] == [40_000] * 2


def test_models_of_the_folds_learn_from_all_other_folds(spark, monkeypatch):
    from trackmetrics.operators import models as M

    fit, seen = B.fit, []
    monkeypatch.setattr(B, "fit", lambda *a, **k: seen.append(fit(*a, **k)) or seen[-1])
    found = M.cross_validate_boosting(many_rows(spark), ["a", "b"], "is_hit", "track_id", (0.1, 3, 5, 1), "boosting")
    assert [r[1:3] for r in found] == [(f, 8_000) for f in range(5)]
    assert [r["cover"] for r in seen[0].where("tree = -1").collect()] == [32_000] * 5
