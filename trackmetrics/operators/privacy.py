"""Pseudonymisation control, sensitive-key scans, purge, k-anonymity, erasure."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.functions.counting import n_distinct, n_rows
from trackmetrics.functions.staging import compute_once


def collision_control(df: DataFrame, user: str, token: Column) -> DataFrame:
    """Distinct ids against distinct tokens, nulls counted apart on both sides."""
    pairs = df.select(F.col(user).alias("u"), token.alias("t")).distinct()
    one = pairs.agg(F.count_if(F.col("u").isNull()).alias("null_users"))
    counted = one.select(n_distinct(pairs, "u").alias("users"), n_distinct(pairs, "t").alias("tokens"), "null_users")
    return counted.withColumn("ok", (F.col("users") == F.col("tokens")).cast("int"))


def _holds(key: str) -> Column:
    """The line holds the key; the cheap substring test runs first."""
    v = F.col("value")
    return F.when(v.contains(key), v.rlike(f'"{key}"\\s*:')).otherwise(False)


def key_scan(lines: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """Per day: lines, lines holding any of the keys, and lines per key; one pass."""
    present = {k: _holds(k) for k in keys}
    touched = reduce(lambda a, b: a | b, present.values())
    return lines.groupBy(day).agg(
        n_rows().alias("n"), F.count_if(touched).alias("touched"), *[F.count_if(c).alias(k) for k, c in present.items()]
    )


def purge_keys(lines: DataFrame, keys: Sequence[str], object_key: str = "additional_info") -> DataFrame:
    """Remove string, number or boolean members named ``keys`` from the lines that hold them; other lines stay byte for byte.

    A line may be cut short: a member whose value is cut by the end of the line goes too.

    Returns the lines with ``purged`` (1 for a changed line).  A sensitive key
    that survives, because it sits elsewhere or holds an object, raises.
    """
    member = r'"(?:' + "|".join(keys) + r')"\s*:\s*(?:"(?:[^"\\]|\\.)*+(?:"|\\?\z)|[-0-9.eE+]+|true|false|null|[a-z]*\z)'
    marked = compute_once(lines, __touched=reduce(lambda a, b: a | b, [_holds(k) for k in keys]))
    cut = F.regexp_replace("value", member + r"\s*,\s*", "")
    cut = F.regexp_replace(F.regexp_replace(cut, r"\s*,\s*" + member, ""), member, "")
    marked = compute_once(marked, __cut=F.when(F.col("__touched"), cut))
    left = F.col("__cut").rlike('"(?:' + "|".join(keys) + r')"\s*:')
    safe = F.when(left, F.raise_error(F.lit("a sensitive key is left after the purge")).cast("string")).otherwise(F.col("__cut"))
    return marked.select(
        *[c for c in lines.columns if c != "value"], F.coalesce(safe, "value").alias("value"), F.col("__touched").cast("int").alias("purged")
    )


def affected_days(lines: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """Days with at least one touched line: the only partitions a purge rewrites."""
    touched = reduce(lambda a, b: a | b, [_holds(k) for k in keys])
    return lines.where(touched).select(day).distinct()


def publishable(groups: DataFrame, listeners: str, k: int) -> DataFrame:
    return groups.where(F.col(listeners) >= k)


def k_measure(groups: DataFrame, listeners: str, listens: str, ks: Sequence[int]) -> DataFrame:
    """Groups and listens kept at each k, in one aggregate."""
    rows = [
        F.struct(
            F.lit(k).alias("k"), n_rows().alias("groups"), F.count_if(F.col(listeners) >= k).alias("kept_groups"),
            F.sum(listens).alias("listens"),
            F.coalesce(F.sum(F.when(F.col(listeners) >= k, F.col(listens))), F.lit(0)).alias("kept_listens"),
        )
        for k in ks
    ]
    return groups.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def subject_rows(df: DataFrame, token: str, subject: Column) -> DataFrame:
    """Access request: the rows of one recomputed token."""
    return df.where(F.col(token) == subject)


def erase_subject(df: DataFrame, token: str, subject: Column, partition: str) -> DataFrame:
    """Erasure request: the affected partitions without the subject's rows, ready for a dynamic overwrite.

    Partition values come from a semi join, so other partitions are not read for the rewrite.
    """
    touched = subject_rows(df, token, subject).select(partition).distinct()
    return df.join(F.broadcast(touched), partition, "left_semi").where(~F.col(token).eqNullSafe(subject))
