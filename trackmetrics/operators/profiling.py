"""One-pass profiles: every measure of a table is an expression of a single aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _long(df: DataFrame, name: str, value: str, metrics: Mapping[str, Column]) -> DataFrame:
    """Run all metrics in one aggregate, then turn the single row into (name, value) rows."""
    one = df.agg(*[c.alias(k) for k, c in metrics.items()])
    return one.unpivot([], list(metrics), name, value)


def out_of_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    metrics = {c: F.count_if((F.col(c) < low) | (F.col(c) > high)) for c, (low, high) in bounds.items()}
    return _long(df, "column_name", "out_of_bounds", metrics)


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column, in percent with three decimals."""
    metrics = {c: F.round(F.avg(F.col(c).isNull().cast("double")) * 100, 3) for c in columns or df.columns}
    return _long(df, "column_name", "null_pct", metrics)


def column_audit(df: DataFrame, columns: Sequence[str], bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Nulls per column and values out of bounds, from one scan."""
    metrics = [F.struct(
        F.lit(c).alias("column_name"),
        F.count_if(F.col(c).isNull()).alias("nulls"),
        (F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])) if c in bounds else F.lit(0).cast("long")).alias("out_of_bounds"),
    ) for c in columns]
    return df.agg(F.array(*metrics).alias("a")).select(F.inline("a"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, extremes and null rate of many columns in one aggregate."""
    rows = []
    for c in columns:
        v = F.col(c).cast("double")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.avg(v).alias("mean"), F.stddev(v).alias("stddev"),
            F.min(v).alias("minimum"), F.max(v).alias("maximum"), F.avg(v.isNull().cast("double")).alias("null_rate"),
        ))
    return df.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def correlations(df: DataFrame, candidates: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Pearson correlation of each candidate with each target, all pairs in one aggregate."""
    rows = [
        F.struct(F.lit(c).alias("variable"), *[F.corr(F.col(c).cast("double"), F.col(y).cast("double")).alias(f"corr_{y}") for y in targets])
        for c in candidates
    ]
    return df.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def column_check(df: DataFrame, expected: Sequence[str], forbidden: Sequence[str] = ()) -> DataFrame:
    """Compare the column names of a table with a whitelist; existing columns come with their filled rows."""
    have = set(df.columns)

    def row(c: str):
        status = "missing" if c not in have else "forbidden" if c in forbidden else "present" if c in expected else "unexpected"
        filled = F.count(F.col(c)) if c in have else F.lit(None).cast("long")
        return F.struct(F.lit(status).alias("status"), F.lit(c).alias("column_name"), filled.alias("filled"))

    return df.agg(F.array(*[row(c) for c in sorted(have | set(expected))]).alias("a")).select(F.inline("a"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key: heaviest, mean, and the factor between them."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"), F.max("n").alias("max_rows"),
        F.round(F.avg("n"), 4).alias("avg_rows"), F.round(F.max("n") / F.avg("n"), 4).alias("factor"),
    )
