"""Hot keys and exact ranks, against brute force, with the split thresholds set very low."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmetrics.operators import ranks as K
from trackmetrics.operators.skew import attach, first_by, lookup, null_safe_join


@pytest.fixture(scope="module")
def hot(spark):
    """900 rows: a third on one key, some without a key, the rest spread."""
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{rng.randrange(40)}", rng.randrange(25)) for i in range(900)]
    return spark.createDataFrame(rows, "id int, key string, v int").cache(), rows


@pytest.mark.parametrize("limit", [10, 100_000])
def test_attach_equals_a_plain_join(hot, limit):
    df, rows = hot
    per_key = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    got = {r["id"]: (r["n"], r["s"]) for r in attach(df, per_key, ["key"], "n", ["id"], hot_rows=limit).collect()}
    assert len(got) == len(rows)
    for i, key, _ in rows:
        same = [v for _, k, v in rows if k == key]
        assert got[i] == (len(same), sum(same))


@pytest.mark.parametrize("limit", [10, 100_000])
def test_lookup_keeps_rows_without_a_key(spark, hot, limit):
    df, rows = hot
    table = spark.createDataFrame([("hot", 1), ("k3", 2)], "key string, code int")
    got = lookup(df, table, "key", ["id"], hot_rows=limit).collect()
    assert len(got) == len(rows)
    assert {r["id"]: r["code"] for r in got} == {i: {"hot": 1, "k3": 2}.get(k) for i, k, _ in rows}


def test_hot_key_is_split_over_salts(hot):
    df, _ = hot
    per_key = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    plan = attach(df, per_key, ["key"], "n", ["id"], hot_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "Cartesian" not in plan


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, b int")
    assert [(r["k"], r["a"], r["b"]) for r in null_safe_join(a, b, ["k"]).collect()] == [(None, 1, 10)]


def test_first_by_takes_the_smallest(hot):
    df, rows = hot
    got = {r["key"]: (r["v"], r["id"]) for r in first_by(df, ["key"], [F.col("v"), -F.col("id")]).collect()}
    for key in {k for _, k, _ in rows}:
        assert got[key] == min(((v, i) for i, k, v in rows if k == key), key=lambda x: (x[0], -x[1]))


@pytest.mark.parametrize("slots", [2, 3, 256])
def test_value_ranks_are_exact(hot, slots):
    df, rows = hot
    values = sorted(v for _, _, v in rows)
    got = K.value_ranks(df, "v", slots=slots).collect()
    assert sorted(r["value"] for r in got) == sorted(set(values))
    for r in got:
        assert r["n"] == values.count(r["value"])
        assert r["upto"] == sum(v <= r["value"] for v in values)
        assert r["total"] == len(values)


def test_value_ranks_per_group(hot):
    df, rows = hot
    for r in K.value_ranks(df, "v", ["key"], slots=3).collect():
        mine = [v for _, k, v in rows if k == r["key"]]
        assert (r["upto"], r["total"]) == (sum(v <= r["value"] for v in mine), len(mine))


@pytest.mark.parametrize("q", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0])
def test_quantiles_against_numpy(spark, q):
    values = [float(x) for x in np.random.default_rng(5).integers(0, 300, 137)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = K.quantiles(df, "v", {"lin": K.linear_quantile(q), "disc": K.existing_quantile(q)}).first()
    assert got["lin"] == pytest.approx(np.quantile(values, q))
    assert got["disc"] == np.quantile(values, q, method="inverted_cdf")


def test_quantile_of_two_known_samples(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "v int")
    got = K.quantiles(df, "v", {"lin": K.linear_quantile(0.75), "disc": K.existing_quantile(0.75)}).first()
    assert (got["lin"], got["disc"]) == (3.25, 3)


def test_spearman_with_ties(spark):
    x = [1, 2, 2, 3, 9, 9, 4]
    y = [2, 1, 4, 4, 8, 7, 7]
    rank = lambda v: [sum(b < a for b in v) + (sum(b == a for b in v) + 1) / 2 for a in v]
    df = spark.createDataFrame(list(zip(x, y)), "x int, y int")
    assert K.spearman(df, "x", "y").first()["rho"] == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1])


def test_spearman_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "x int, y int")
    assert K.spearman(df, "x", "y").first()["rho"] == 0.0
