"""Joins and argmax aggregates that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# A key with more rows than this is split over several tasks.  The list of such
# keys has at most (table rows / HOT_ROWS) entries, which bounds its broadcast.
HOT_ROWS = 2_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key; keys come from ``left`` (inner, left, semi, anti)."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def attach(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    weight: str,
    spread: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join a one-row-per-key table back to its rows.

    ``weight`` is the column of ``per_key`` that counts the rows of a key.  A key
    heavier than ``hot_rows`` is cut in ceil(weight / hot_rows) parts by a hash
    of the ``spread`` columns, and its single row is repeated once per part.
    """
    parts = F.ceil(F.col(weight) / F.lit(hot_rows)).cast("int")
    hot = per_key.where(F.col(weight) > hot_rows).select(*keys, parts.alias("__parts"))
    salted = null_safe_join(rows, F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*spread), F.coalesce(F.col("__parts"), F.lit(1))).cast("int")
    )
    repeated = per_key.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return null_safe_join(salted, repeated, [*keys, "__salt"], "left").drop("__salt", "__parts")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread: Sequence[str],
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join to a table with one row per ``key``, for a key column that may be null or hot.

    Rows without a key would all hash to one task, so they are spread by a salt
    that matches nothing; keys with more than ``hot_rows`` rows are split as in
    :func:`attach`.  In a chain of lookups pass the first input as ``hot_from``,
    so that keys are counted there and not on the result of the joins before.
    """
    n = F.count(F.lit(1))
    counted = rows if hot_from is None else hot_from
    hot = counted.where(F.col(key).isNotNull()).groupBy(key).agg(n.alias("__n")).where(F.col("__n") > hot_rows)
    hot = F.broadcast(hot.select(key, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__parts")))
    parts = F.when(F.col(key).isNull(), F.lit(4096)).otherwise(F.coalesce(F.col("__parts"), F.lit(1)))
    salted = rows.join(hot, key, "left").withColumn("__salt", F.pmod(F.xxhash64(*spread), parts).cast("int"))
    repeated = table.join(hot, key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1))
    )
    return salted.drop("__parts").join(repeated.drop("__parts"), [key, "__salt"], "left").drop("__salt")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Keep the row that comes first for each key: by ``order``, then by the other columns, so the choice is total.

    Nulls come last, in ``order`` and in the columns.  Written as ``min(struct)``, so each map task already reduces a hot key to
    one row; a ``row_number`` window would send the whole key to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [x for i, c in enumerate([*order, *[F.col(c) for c in rest]]) for x in (c.isNull().alias(f"__n{i}"), c.alias(f"__o{i}"))]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("__best"))
    first = len(order)
    return best.select(*keys, *[F.col(f"__best.__o{first + i}").alias(c) for i, c in enumerate(rest)])
