"""Sketches against exact measures."""

from pyspark.sql import functions as F

from trackmetrics.operators import sketches as SK

RANKS = {"low": 0.05, "median": 0.5, "high": 0.95}


def test_merged_quantiles_stay_within_their_rank_error(spark):
    """Days of very different sizes and ranges; a tenth of the values are equal and some are null."""
    value = F.when(F.col("id") % 10 == 0, 5.0).when(F.col("id") % 11 == 0, None).otherwise(F.pmod(F.hash("id"), F.lit(100_000)) * (F.col("id") % 3 + 1))
    rows = spark.range(60_000).select((F.col("id") % 2).alias("g"), F.floor(F.sqrt("id") / 20).alias("day"), value.cast("double").alias("v"))
    days = SK.quantile_sketches(rows, "v", ["g", "day"])
    merged = SK.merged_quantiles(days, ["g"], RANKS)
    found = {r["g"]: r for r in merged.collect()}
    assert {g: r["n"] for g, r in found.items()} == {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count("v").alias("n")).collect()}
    fixed = spark.createDataFrame([(r["g"], r["n"], r["parts"], r["low"], r["median"], r["high"]) for r in found.values()], merged.schema)
    for r in SK.rank_errors(rows, "v", fixed, ["g"], RANKS).collect():
        assert max(r[c] for c in RANKS) <= SK.RANK_ERROR


def test_rank_error_sees_a_wrong_quantile(spark):
    rows = spark.range(1_000).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    wrong = spark.createDataFrame([(1, 100.0)], "g int, median double")
    assert abs(SK.rank_errors(rows, "v", wrong, ["g"], {"median": 0.5}).first()["median"] - 0.399) < 1e-9


def test_overlap_from_sketches(spark):
    left = spark.range(0, 60_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"))
    right = spark.range(30_000, 90_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    found = {r["g"]: r["estimate"] for r in SK.overlap_estimates(SK.key_sketches(left, ["k"], ["g"]), SK.key_sketches(right, ["k"], ["g"]), ["g"]).collect()}
    assert set(found) == {0, 1} and all(abs(n - 5_000) <= 400 for n in found.values())


def test_small_sets_are_exact_and_empty_ones_absent(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", None), ("b", 1)], "g string, k int")
    right = spark.createDataFrame([("a", 2), ("a", 3), ("b", 9), ("c", 1)], "g string, k int")
    found = SK.overlap_estimates(SK.key_sketches(left, ["k"], ["g"]), SK.key_sketches(right, ["k"], ["g"]), ["g"])
    assert {tuple(r) for r in found.collect()} == {("a", 1), ("b", 0)}
    assert SK.overlap_estimates(SK.key_sketches(left.where("false"), ["k"], ["g"]), SK.key_sketches(right, ["k"], ["g"]), ["g"]).count() == 0
