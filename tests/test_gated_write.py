"""A gate measured while its table is written."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trackmetrics.operators import loading
from trackmetrics.operators import quality as Q


def check(limit):
    return Q.Check("small", "volume", Q.BLOCK, "at most", {"n": F.count(F.lit(1)), "top": F.max("v")}, F.coalesce(F.col("small.top"), F.lit(0)) <= limit)


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs}


def table(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("CONCAT('2026-0', id % 3 + 1) AS mois", "id AS v")


def test_a_refused_load_leaves_every_file(spark, tmp_path):
    path = str(tmp_path / "t")
    first = loading.gated_write(table(spark, 0, 30), f"file://{path}", ["mois"], [check(50)]).collect()
    assert [(r["observed"], r["ok"], r["published"]) for r in first] == [("n=30, top=29", 1, 1)]
    before = files(path)
    second = loading.gated_write(table(spark, 0, 90), f"file://{path}", ["mois"], [check(50)]).collect()
    assert [(r["observed"], r["ok"], r["published"]) for r in second] == [("n=90, top=89", 0, 0)]
    assert files(path) == before
    only = table(spark, 0, 12).where("mois = '2026-02'")
    loading.gated_write(only, f"file://{path}", ["mois"], [check(50)])
    months = {r["mois"]: r["n"] for r in spark.read.parquet(path).groupBy("mois").agg(F.count("v").alias("n")).collect()}
    assert {str(k): n for k, n in months.items()} == {"2026-01": 10, "2026-02": 4, "2026-03": 10}
    assert not [d for d in os.listdir(path) if d.startswith("_")]


def test_empty_input_and_metrics_that_cannot_be_observed(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    report = loading.gated_write(table(spark, 0, 0), path, ["mois"], [check(50)]).collect()
    assert [(r["observed"], r["published"]) for r in report] == [("n=0, top=null", 1)]
    distinct = Q.Check("d", "volume", Q.BLOCK, "", {"n": F.count_distinct("v")}, F.lit(True))
    with pytest.raises(AnalysisException):
        loading.gated_write(table(spark, 0, 9), path, ["mois"], [distinct])


def test_warnings_do_not_refuse(spark, tmp_path):
    warn = Q.Check("w", "volume", Q.WARN, "", {"n": F.count(F.lit(1))}, F.col("w.n") > 100)
    assert loading.gated_write(table(spark, 0, 9), f"file://{tmp_path}/t", ["mois"], [warn]).first()["published"] == 1
