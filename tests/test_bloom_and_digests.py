"""Bloom filters and digest trees against plain joins."""

import datetime

import pytest
from pyspark.sql import functions as F

from trackmetrics.operators import bloom, digest_tree as DT


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(0, 3_000).select(F.col("id").alias("a"), F.concat(F.lit("k"), F.col("id") % 7).alias("b"))
    rows = spark.range(0, 100_000).select(F.col("id").alias("a"), F.concat(F.lit("k"), F.col("id") % 7).alias("b"), F.lit(1).alias("x"))
    passed = bloom.may_hold(rows, keys, ["a", "b"])
    assert passed.columns == rows.columns and passed.where("a < 3000").count() == 3_000
    assert passed.where("a >= 3000").count() < 0.03 * 97_000
    assert passed.where("a >= 3000").count() > 0  # it is a filter, not a join


def test_rows_are_not_shuffled_by_the_filter(spark):
    rows, keys = spark.range(0, 1_000, numPartitions=3).withColumnRenamed("id", "a"), spark.range(0, 10).withColumnRenamed("id", "a")
    plan = bloom.may_hold(rows, keys, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_too_large_a_filter_lets_all_rows_pass(spark):
    rows = spark.range(0, 50).withColumnRenamed("id", "a")
    assert bloom.may_hold(rows, spark.range(0, 1_000).withColumnRenamed("id", "a"), ["a"], max_slots=10).count() == 50


@pytest.mark.parametrize("keys", [[], [(None, "x")]])
def test_empty_and_null_keys(spark, keys):
    table = spark.createDataFrame(keys, "a int, b string")
    rows = spark.createDataFrame([(None, "x"), (1, None), (None, None)], "a int, b string")
    passed = {tuple(r) for r in bloom.may_hold(rows, table, ["a", "b"]).collect()}
    assert set(keys) <= passed


def facts(spark, rows):
    data = [(datetime.date.fromisoformat(d), m, x, y, d[:7]) for d, m, x, y in rows]
    return spark.createDataFrame(data, "date date, msid string, listens long, listeners long, mois string")


ROWS = [(f"2024-{m:02d}-{d:02d}", f"m{k}", m * d + k, k) for m in (1, 2, 3) for d in (1, 9, 17) for k in range(20)]


def days(spark, left, right, level=2):
    trees = [DT.digest_tree(facts(spark, r), "msid", ["listens", "listeners"]) for r in (left, right)]
    return {tuple(r) for r in DT.differing(*trees, level=level).collect()}


def test_equal_tables_in_any_order(spark):
    assert days(spark, ROWS, ROWS[::-1]) == set() and days(spark, [], []) == set()


def test_every_kind_of_difference_is_located(spark):
    changed = [(d, m, x + 1, y) if (d, m) == ("2024-01-09", "m3") else (d, m, x, y) for d, m, x, y in ROWS]
    assert days(spark, ROWS, changed) == {("2024-01", "2024-01-09", 20, 20)}
    swapped = [(d, {"m1": "m2", "m2": "m1"}.get(m, m) if d == "2024-02-17" else m, x, y) for d, m, x, y in ROWS]
    assert days(spark, ROWS, swapped) == {("2024-02", "2024-02-17", 20, 20)}
    gone = [r for r in ROWS if r[0] != "2024-03-01"]
    assert days(spark, ROWS, gone) == {("2024-03", "2024-03-01", 20, None)} and days(spark, gone, ROWS) == {("2024-03", "2024-03-01", None, 20)}
    null = [(d, m, None if (d, m) == ("2024-03-17", "m0") else x, y) for d, m, x, y in ROWS]
    assert days(spark, ROWS, null) == {("2024-03", "2024-03-17", 20, 20)}
    assert len(days(spark, ROWS, changed, level=3)) == 1 and days(spark, ROWS, changed, level=1) == {("2024-01", 60, 60)}
    assert days(spark, ROWS, []) == {(d[:7], d, 20, None) for d, *_ in ROWS}


def test_rows_are_read_for_differing_days_only(spark, tmp_path):
    changed = [(d, m, x + (m == "m3" and d == "2024-01-09"), y) for d, m, x, y in ROWS] + [("2024-02-09", "new", 1, 1)]
    left, right = facts(spark, ROWS), facts(spark, changed)
    for table, name in ((left, "left"), (right, "right")):
        table.write.partitionBy("mois", "date").parquet(str(tmp_path / name))
    place = DT.differing(*[DT.digest_tree(x, "msid", ["listens", "listeners"]) for x in (left, right)], level=2)
    stored = [spark.read.parquet(str(tmp_path / n)) for n in ("left", "right")]
    for path in tmp_path.rglob("*.parquet"):
        if path.parent.name not in ("date=2024-01-09", "date=2024-02-09"):
            path.write_bytes(b"unreadable")
    found = DT.changed_rows(*stored, place, "msid", ["listens", "listeners"])
    assert {tuple(r) for r in found.collect()} == {("2024-01-09", "m3", "changed"), ("2024-02-09", "new", "added")}
