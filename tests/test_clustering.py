"""Order along a Morton curve: its numbers, files it lets a query skip, and rows that lie out of order."""

import random

from pyspark.sql import functions as F

from trackmetrics.plans import storage, warehouse
from trackmetrics.sources import clustering as C
from trackmetrics.sources.views import Tables
from tests.parity import DATA

FOLDER = str(DATA / "sf0.001")


def test_interleave_takes_bits_in_turn(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for r in df.select("a", "b", C.interleave([F.col("a"), F.col("b")], bits=3).alias("m")).collect():
        assert r["m"] == int("".join(x + y for x, y in zip(f"{r['a']:03b}", f"{r['b']:03b}")), 2)


def test_slots_hold_equal_shares_and_nulls_come_first(spark):
    df = spark.range(6400).select((F.col("id") * F.col("id")).alias("v"), F.lit(None).cast("date").alias("d"))
    bounds = C.slot_bounds(df, ["v", "d"])
    slots = df.select(C.slot(F.col("v"), bounds["v"]).alias("s"), C.slot(F.col("d"), bounds["d"]).alias("e"))
    per_slot = [r["count"] for r in slots.groupBy("s").count().collect()]
    assert len(per_slot) == 64 and max(per_slot) <= 130
    assert slots.agg(F.max("e")).first()[0] == 0
    empty = df.where("v < 0")
    assert C.clustered(empty, ["v", "d"], 4).count() == 0


def test_a_hot_value_is_cut_along_the_other_column_and_no_row_is_lost(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, 7 if i % 3 else rng.randrange(1000), rng.randrange(1000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, a int, b int").repartition(5)
    path = str(tmp_path / "curve")
    C.clustered(df, ["a", "b"], 16).write.parquet(path)
    stored = spark.read.parquet(path)
    assert sorted(tuple(r) for r in stored.collect()) == sorted(rows)
    sizes = [r["n"] for r in C.file_ranges(stored, ["a", "b"]).collect()]
    assert max(sizes) < 3 * len(rows) / 16


def test_touched_is_the_files_that_hold_a_row_or_could(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") % 10).alias("k")).repartitionByRange(5, "id").write.parquet(path)
    stored = spark.read.parquet(path)
    found = {r["box"]: (r["touched"], r["files"]) for r in C.touched(C.file_ranges(stored, ["id", "k"]), {
        "one": {"id": (0, 1)}, "all": {"id": (0, 100)}, "none": {"id": (100, 200)}, "k": {"id": (0, 1), "k": (50, 60)}}).collect()}
    files = found["all"][1]
    assert found == {"one": (1, files), "all": (files, files), "none": (0, files), "k": (0, files)} and files == 5


def test_unsorted_share_counts_rows_of_files_that_begin_too_early(spark):
    ranges = spark.createDataFrame([("a", 10, 1, 5), ("b", 10, 5, 9), ("c", 20, 8, 12), ("d", 40, 12, 12)], "file string, n long, k__low int, k__high int")
    assert C.unsorted_share(ranges, "k", F.lit("p")).first()["unsorted_pct"] == 25.0


def test_the_curve_serves_boxes_of_either_column(spark):
    t = Tables(spark, FOLDER)
    found = {(r["layout"], r["box"]): r["touched"] for r in storage.files_touched(t).collect()}
    worst = lambda layout: max(found[layout, b] for b in ("days", "titles"))
    assert worst("curve") < worst("range") and worst("curve") < worst("hash")
    assert found["curve", "both"] < found["hash", "both"]


def test_footprint_states_the_unsorted_share(spark):
    rows = warehouse.physical_footprint(Tables(spark, FOLDER)).collect()
    assert rows and all(0 <= r["unsorted_pct"] <= 100 for r in rows)
