"""Sketches kept per day or month and merged later: quantiles (KLL) and overlaps of key sets (theta).

A sketch is a binary of bounded size, so a year of days merges without reading an event again, and a group of
any size is one row per map task.  Estimates come with the exact measure beside them where a query reports them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trackmetrics.functions.counting import n_rows

#: Size of a quantile sketch, and the rank error it stays within (1.65 % holds for half this size, with 99 % confidence).
KLL_K = 400
RANK_ERROR = 0.0165
#: Log of the entries of a theta sketch: about one percent of error on a set.
THETA_LG = 14


def quantile_sketches(rows: DataFrame, value: str, keys: Sequence[str], k: int = KLL_K) -> DataFrame:
    """A quantile sketch and the number of values per group of ``keys`` (the day among them); nulls are no values."""
    number = F.col(value).cast("double")
    return rows.where(number.isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"), n_rows().alias("n"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], ranks: dict[str, float]) -> DataFrame:
    """Quantiles of merged groups: a column per rank, ``n`` values and ``parts`` sketches."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), n_rows().alias("parts"))
    return merged.select(*by, "n", "parts", *[F.kll_sketch_get_quantile_double("sketch", F.lit(r)).alias(c) for c, r in ranks.items()])


def rank_errors(rows: DataFrame, value: str, estimates: DataFrame, by: Sequence[str], ranks: dict[str, float]) -> DataFrame:
    """Per group: the distance of each wanted rank from the ranks its estimate really has in the rows (0 if it is among them)."""
    number = F.col(value).cast("double")
    joined = rows.where(number.isNotNull()).join(estimates.select(*by, *ranks), list(by))
    counted = joined.groupBy(*by).agg(
        n_rows().alias("__n"), *[F.count_if(number < F.col(c)).alias(f"__b_{c}") for c in ranks], *[F.count_if(number <= F.col(c)).alias(f"__u_{c}") for c in ranks]
    )
    error = lambda c, r: F.greatest(F.col(f"__b_{c}") / F.col("__n") - r, F.lit(r) - F.col(f"__u_{c}") / F.col("__n"), F.lit(0.0))
    return counted.select(*by, *[error(c, r).alias(c) for c, r in ranks.items()])


def key_sketches(rows: DataFrame, keys: Sequence[str], by: Sequence[str], lg: int = THETA_LG) -> DataFrame:
    """A theta sketch of the distinct keys per group, keys without nulls."""
    present = rows.dropna(subset=list(keys))
    return present.groupBy(*by).agg(F.theta_sketch_agg(F.xxhash64(*keys), lg).alias("sketch"))


def overlap_estimates(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimated number of keys that both sides hold, per group present on both, from the sketches alone."""
    both = left.select(*by, "sketch", F.lit(0).alias("side")).unionByName(right.select(*by, "sketch", F.lit(1).alias("side")))
    met = both.groupBy(*by).agg(F.theta_intersection_agg("sketch").alias("sketch"), F.count_distinct("side").alias("sides"))
    return met.where("sides = 2").select(*by, F.theta_sketch_estimate("sketch").alias("estimate"))
