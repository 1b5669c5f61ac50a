"""Forests against exhaustive search and against MLlib's forest on the same rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmetrics.operators import binned
from trackmetrics.operators import forest as R
from trackmetrics.operators import models as M


def planted(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = (rng.random(n) < 1 / (1 + np.exp(1 - 2 * x[:, 0] + x[:, 1] * x[:, 2]))).astype(int)
    return x, y


def table(spark, x, y, partitions=3):
    rows = [(i, i % 3, int(v), *map(float, r)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, fold int, is_hit int, a double, b double, c double, d double").repartition(partitions)


def test_thresholds_are_all_midpoints_or_strides_of_equal_weight():
    y = np.array([0, 0, 1, 1])
    assert R.weighted_cuts(np.array([1.0, 2.0, 2.0, 4.0]), y).tolist() == [1.5, 3.0]
    assert R.weighted_cuts(np.array([np.nan, 3.0, 3.0, 3.0]), y).tolist() == []
    many = np.arange(3200.0)
    cuts = R.weighted_cuts(many, (many % 2).astype(int))
    assert len(cuts) == 31 and np.diff([0, *np.searchsorted(many, cuts), 3200]).tolist() == [100] * 32


def test_every_split_has_the_least_impurity_of_the_features_asked_and_leaves_keep_their_rows():
    x, y = planted()
    x = x[:, :1]  # one feature: none is drawn
    cuts = [R.weighted_cuts(x[:, 0], y)]
    codes = binned.codes_of(cuts, x)[0]
    low, high = R.class_weights(y)
    tree = R.grow((codes << 1 | y).astype(np.uint8), 1, (low, high), 30, 5, np.random.default_rng([1, 0]))
    times = np.random.default_rng([1, 0]).poisson(1.0, len(y))

    def impurity(at):
        a, b = low * times[at & (y == 0)].sum(), high * times[at & (y == 1)].sum()
        return a * b / (a + b) if a + b else 0.0

    def walk(node, at):
        a, b = low * times[at & (y == 0)].sum(), high * times[at & (y == 1)].sum()
        if tree.feature[node] < 0:
            assert tree.value[node] == pytest.approx(b / (a + b)) and times[at].sum() >= 5
            return
        found = [impurity(at & (codes <= c)) + impurity(at & (codes > c)) for c in range(31)
                 if min(times[at & (codes <= c)].sum(), times[at & (codes > c)].sum()) >= 5]
        assert impurity(at & (codes <= tree.cut[node])) + impurity(at & (codes > tree.cut[node])) == pytest.approx(min(found))
        below = tree.below[node]
        if tree.feature[below] < 0 and tree.feature[below + 1] < 0:  # leaves of one verdict are one leaf
            assert (tree.value[below] > 0.5) != (tree.value[below + 1] > 0.5)
        walk(below, at & (codes <= tree.cut[node]))
        walk(below + 1, at & (codes > tree.cut[node]))

    walk(0, np.ones(len(y), bool))
    assert len(tree.feature) > 5 and tree.importance.tolist() == [1.0]


def test_forest_agrees_with_that_of_mllib_and_does_not_depend_on_partitions(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    x, y = planted(n=1500)
    features = list("abcd")
    make = lambda: M.forest(features, "is_hit", 60)
    scores = []
    for partitions in (1, 5):
        df = table(spark, x, y, partitions)
        scored = M.held_out(df.where("fold > 0"), df.where("fold = 0"), "is_hit", make, "held")
        scores.append(sorted(map(tuple, scored.collect())))
    assert scores[0] == scores[1] and len(scores[0]) == 500
    train, test = df.where("fold > 0"), df.where("fold = 0")
    mllib = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="x"), RandomForestClassifier(
        featuresCol="x", labelCol="is_hit", weightCol="weight", numTrees=60, maxDepth=30, minInstancesPerNode=5, seed=1)]).fit(M.class_weights(train, "is_hit"))
    other = mllib.transform(test).withColumn("score", M.vector_to_array("probability")[1])
    auc = lambda rows: M.auc(rows, "is_hit").first()["auc"]
    assert auc(scored) == pytest.approx(auc(other), abs=0.01)
    model = M.fitted(make, train, "is_hit")
    assert model.stages[-1].featureImportances.toArray() == pytest.approx(mllib.stages[-1].featureImportances.toArray(), abs=0.02)
    assert sorted(map(tuple, M.score(model, test).collect())) == scores[1]


def test_published_forest_scores_as_it_did(spark, tmp_path):
    x, y = planted()
    df = table(spark, x, y)
    model = M.fitted(lambda: M.forest(list("abcd"), "is_hit", 30, 5), df, "is_hit")
    M.publish(model, str(tmp_path / "forest"), {"model": "forest"})
    again = M.published(spark, str(tmp_path / "forest"), "forest")
    assert sorted(map(tuple, M.score(again, df).collect())) == sorted(map(tuple, M.score(model, df).collect()))


def test_permutation_scores_each_row_with_one_value_of_its_donor(spark):
    x, y = planted(n=120)
    df = table(spark, x, y)
    features = list("abcd")
    model = M.fitted(lambda: M.forest(features, "is_hit", 30, 6), df, "is_hit")
    paired = M.materialise(M.with_donor(df, features, "id"), "donors")
    found = [tuple(r["scores"]) for r in model.stages[-1].permuted(paired).collect()]
    for i, f in enumerate([None, *features]):
        swapped = paired if f is None else paired.withColumn(f, F.col(f"donor.{f}"))
        assert sorted(s[i] for s in found) == pytest.approx(sorted(r["score"] for r in M.score(model, swapped).collect()))
    assert M.permutation_ranking(model, paired, "is_hit", features)[0][0] == "a"


def test_forest_of_many_rows_runs_few_jobs(spark):
    """MLlib's forest ran a job per group of nodes, hundreds for deep trees."""
    x, y = planted(n=3000)
    df = M.materialise(table(spark, x, y), "rows")
    before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    before = before.get() if hasattr(before, "get") else before
    M.held_out(df.where("fold > 0"), df.where("fold = 0"), "is_hit", lambda: M.forest(list("abcd"), "is_hit", 50), "few")
    after = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    after = after.get() if hasattr(after, "get") else after
    assert after - before < 15


def test_forest_edge_cases(spark):
    x, y = planted(n=60)
    df = table(spark, x, y)
    make = lambda: M.forest(list("abcd"), "is_hit", 3, 4)
    one = M.held_out(df.where("is_hit = 0"), df, "is_hit", make, "one")
    assert one.agg(F.max("score"), F.count("*")).first()[:] == (0.0, 60)
    nothing = M.held_out(df.where("id < 0"), df, "is_hit", make, "nothing")
    assert nothing.count() == 60 and nothing.where("score IS NOT NULL").count() == 0
    odd = df.withColumn("is_hit", F.when(F.col("id") % 7 > 0, F.col("is_hit"))).withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    assert M.held_out(odd, odd, "is_hit", make, "odd").where("score BETWEEN 0 AND 1").count() == 60
