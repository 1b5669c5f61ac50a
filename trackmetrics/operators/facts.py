"""Day x title facts, exact and with mergeable listener sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows

LG_K = 12


def day_facts(
    listens: DataFrame, user: str = "user_tok", title: str = "msid", seconds: str = "ts_s", unique: bool = False
) -> DataFrame:
    """Listens and listeners per day and title, without the listener token.

    A listen is a distinct (listener, second, title).  The distinct set is one
    aggregate on all keys, so neither a hot title nor a hot listener gathers in
    a task; the second level only adds up.  ``listeners`` counts one group, so
    the sum over two origins is an upper bound.  Events known to be distinct
    (``unique``) skip the first shuffle.
    """
    once = listens.select(X.day_of(F.col(seconds)).alias("date"), title, user, seconds)
    if not unique:
        once = once.distinct()
    per_listener = once.groupBy("date", title, user).agg(n_rows().alias("n"))
    facts = per_listener.groupBy("date", title).agg(F.sum("n").alias("listens"), n_rows().alias("listeners"))
    return facts.withColumn("mois", X.month_of(F.col("date")))


def day_sketches(listens: DataFrame, user: str = "user_tok", title: str = "msid") -> DataFrame:
    """Listens and an HLL sketch of the listeners per day and title; sketches merge across days."""
    return listens.groupBy("date", title).agg(n_rows().alias("listens"), F.hll_sketch_agg(user, LG_K).alias("sketch"))


def union_estimate(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct listeners of merged groups, next to the naive sum of the group estimates."""
    return sketches.groupBy(*keys).agg(
        F.sum("listens").alias("listens"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("listeners"),
        F.sum(F.hll_sketch_estimate("sketch")).alias("naive_sum"),
    )


def grain_rollup(listens: DataFrame, user: str, title: str, k: int = 5) -> DataFrame:
    """For day, ISO week and month: groups, listens, share of small groups, listens kept at k listeners.

    One pass: each row is first reduced to (day, title, listener), then copied
    to its three periods.
    """
    base = listens.groupBy("date", title, user).agg(n_rows().alias("n"))
    periods = F.array(
        F.struct(F.lit("jour").alias("grain"), F.col("date").alias("period")),
        F.struct(F.lit("semaine").alias("grain"), F.date_trunc("week", "date").cast("date").alias("period")),
        F.struct(F.lit("mois").alias("grain"), F.date_trunc("month", "date").cast("date").alias("period")),
    )
    spread = base.select(F.inline(periods), title, user, "n")
    per_user = spread.groupBy("grain", "period", title, user).agg(F.sum("n").alias("n"))
    groups = per_user.groupBy("grain", "period", title).agg(F.sum("n").alias("listens"), n_rows().alias("listeners"))
    small = lambda limit: F.round(F.avg((F.col("listeners") < limit).cast("double")), 4)
    per_period = groups.groupBy("grain").agg(
        n_rows().alias("groups"), F.sum("listens").alias("listens"), F.count_distinct("period").alias("periods"),
        small(2).alias("share_1"), small(5).alias("share_under_5"), small(10).alias("share_under_10"),
        F.sum(F.when(F.col("listeners") >= k, F.col("listens")).otherwise(0)).alias("listens_at_k"),
    )
    return per_period
