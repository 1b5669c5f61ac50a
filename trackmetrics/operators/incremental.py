"""Incremental batches: late data, duplicates between batches, continuity, freshness, merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.operators.bloom import may_hold
from trackmetrics.operators.ranks import existing_quantile, value_ranks
from trackmetrics.operators.skew import null_safe_join
from trackmetrics.session import materialise
from trackmetrics.sources.layout import read_partitioned, write_rebalanced

# Lateness limit in days, and the partition of older events.
LATE_DAYS = 30
OLD = "_ancien"
# Upper limit in days of each lateness band, and its label.
BANDS = ((-1, "a_negatif"), (0, "b_0j"), (1, "c_1j"), (7, "d_2-7j"), (30, "e_8-30j"), (365, "f_31-365j"))
LAST_BAND = "g_plus_365j"
EVENT_KEY = ("user_tok", "ts_s", "msid")


def lateness(reception: str, day: str) -> Column:
    return F.datediff(F.col(reception), F.col(day))


def lateness_bands(df: DataFrame, reception: str, day: str) -> DataFrame:
    late = lateness(reception, day)
    band = F.when(late <= BANDS[0][0], BANDS[0][1])
    for limit, label in BANDS[1:]:
        band = band.when(late <= limit, label)
    return df.groupBy(band.otherwise(LAST_BAND).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(day).alias("days")
    )


def route_late(df: DataFrame, reception: str, day: str, limit: int = LATE_DAYS) -> DataFrame:
    """Partition value ``jour``: the event day, or ``_ancien`` when it is received later than ``limit`` days.

    An event dated after its reception counts as recent.
    """
    on_time = lateness(reception, day) <= limit
    return df.withColumn("jour", F.when(on_time, F.date_format(day, "yyyy-MM-dd")).otherwise(F.lit(OLD)))


def routing_errors(df: DataFrame, reception: str, day: str, limit: int = LATE_DAYS) -> DataFrame:
    """Rows whose stored ``jour`` contradicts their dates."""
    late, old = lateness(reception, day) > limit, F.col("jour") == OLD
    wrong_day = ~old & (F.col("jour") != F.date_format(day, "yyyy-MM-dd"))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(old & ~late).alias("recent_in_old"),
        F.count_if(~old & late).alias("old_in_recent"),
        F.count_if(wrong_day).alias("wrong_day"),
    )


def duplicate_anatomy(df: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """Duplicate groups of a key: how many, rows in excess, between batches and inside one batch."""
    per_batch = df.groupBy(*keys, batch).agg(F.count(F.lit(1)).alias("n"))
    per_key = per_batch.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches")).where(F.col("n") > 1)
    return per_key.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"),
        F.count_if(F.col("batches") > 1).alias("between_batches"),
        F.coalesce(F.sum(F.col("n") - F.col("batches")), F.lit(0)).alias("inside_batch"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and order-free digest of a table; equal tables give equal digests, and a null counts at its place."""
    value = lambda c: F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("~"))
    text = F.concat_ws("|", *[value(F.col(c).cast("string")) for c in columns])
    digest = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(digest).cast("string").alias("digest"))


def lateness_profile(df: DataFrame, reception: str, day: str) -> DataFrame:
    """P50, P90 and P99 of the lateness in days (values that occur)."""
    ranked = value_ranks(df.select(lateness(reception, day).alias("late")), "late")
    return ranked.agg(
        F.max("total").alias("n"),
        *[existing_quantile(q).alias(name) for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))],
    )


def continuity(bounds: DataFrame) -> DataFrame:
    """Verdict of each batch against its neighbours, from (no, start_s, end_s).

    The end is checked against the next loaded batch first, then the start
    against the previous one.  The window has no partition: a ledger holds one
    short row per batch, a few hundred a year.
    """
    order = Window.orderBy("no")
    end_prev, start_next = F.lag("end_s").over(order), F.lead("start_s").over(order)
    verdict = (
        F.when(F.col("end_s") < F.col("start_next"), "TROU")
        .when(F.col("end_s") > F.col("start_next"), "CHEVAUCHEMENT")
        .when(F.col("end_prev").isNull(), "PREMIER")
        .when(F.col("start_s") == F.col("end_prev"), "SUITE")
        .when(F.col("start_s") > F.col("end_prev"), "TROU")
        .otherwise("CHEVAUCHEMENT")
    )
    return (
        bounds.withColumns({"end_prev": end_prev, "start_next": start_next})
        .withColumn("verdict", verdict)
    )


def candidate_continuity(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Verdict of each candidate batch against the batches already in the ledger.

    Candidates and ledger are merged in one ordered list; for each candidate the
    nearest ledger rows below and above are carried by ``last``/``first``.
    """
    tagged = ledger.select("no", "start_s", "end_s", F.lit(1).alias("loaded")).unionByName(
        candidates.select("no", "start_s", "end_s", F.lit(0).alias("loaded"))
    )
    per_no = tagged.groupBy("no").agg(
        F.max(F.when(F.col("loaded") == 1, F.struct("start_s", "end_s"))).alias("old"),
        F.max(F.when(F.col("loaded") == 0, F.struct("start_s", "end_s"))).alias("new"),
    )
    before = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("no").rowsBetween(1, Window.unboundedFollowing)
    seen = per_no.select(
        "no", "old", "new",
        F.last("old", ignorenulls=True).over(before).alias("prev"),
        F.first("old", ignorenulls=True).over(after).alias("next"),
    ).where(F.col("new").isNotNull())
    start, end = F.col("new.start_s"), F.col("new.end_s")
    verdict = (
        F.when(F.col("old").isNotNull(), "RECHARGEMENT")
        .when(end < F.col("next.start_s"), "TROU")
        .when(end > F.col("next.start_s"), "CHEVAUCHEMENT")
        .when(F.col("prev").isNull(), "PREMIER")
        .when(start == F.col("prev.end_s"), "SUITE")
        .when(start > F.col("prev.end_s"), "TROU")
        .otherwise("CHEVAUCHEMENT")
    )
    return seen.select("no", verdict.alias("verdict"))


def pending(published: DataFrame, ledger: DataFrame) -> DataFrame:
    """Published batches above the last loaded one, in order; numbers may have gaps.

    An empty ledger is an error: the starting point is loaded by hand.
    """
    last = ledger.agg(F.max("no")).scalar()
    guarded = F.when(last.isNull(), F.raise_error(F.lit("empty ledger: load the first batch by hand")).cast("int")).otherwise(last)
    return published.where(F.col("no") > guarded).orderBy("no")


def freshness(ledger: DataFrame) -> DataFrame:
    """Per batch: seconds from its end to its registration and share of recent rows.

    Needs (no, end_s, registered_s, n_rows, recent, old); an inconsistent batch is kept with its error.
    """
    seconds = F.col("registered_s") - F.col("end_s")
    error = (
        F.when(F.col("recent") + F.col("old") != F.col("n_rows"), "row counts differ")
        .when(seconds <= 0, "registered before its end")
    )
    share = F.when(F.col("n_rows") > 0, F.round(100.0 * F.col("recent") / F.col("n_rows"), 4)).otherwise(0.0)
    return ledger.select("no", seconds.alias("freshness_s"), share.alias("recent_pct"), F.col("n_rows"), error.alias("error"))


def alerts(runs: DataFrame, now_s: Column, silence_s: int = 86_400, stale_s: int = 129_600) -> DataFrame:
    """Three rules on the runs of the loader: a failure, no success in a day, freshness above 36 hours."""
    one = runs.agg(
        F.count_if(~F.col("ok")).alias("failures"),
        F.coalesce(now_s - F.max(F.when(F.col("ok"), F.col("registered_s"))) > silence_s, F.lit(True)).alias("silent"),
        F.count_if(F.col("ok") & (F.col("registered_s") - F.col("end_s") > stale_s)).alias("stale"),
    )
    return one.select(F.inline(F.array(
        F.struct(F.lit("load_failed").alias("rule"), (F.col("failures") >= 1).cast("int").alias("raised")),
        F.struct(F.lit("no_load_24h").alias("rule"), F.col("silent").cast("int").alias("raised")),
        F.struct(F.lit("stale_36h").alias("rule"), (F.col("stale") >= 1).cast("int").alias("raised")),
    )))


def volume_anomalies(series: DataFrame, lot: str, n: str, window: int, high: float, low: float, history: int) -> DataFrame:
    """Lots whose volume leaves [low, high] times the median of the ``window`` previous lots.

    A lot is judged once ``history`` lots precede it; a zero median gives an
    infinite ratio.  ``series`` holds one row per month or day, so the calendar
    bounds the unpartitioned window.
    """
    previous = Window.orderBy(lot).rowsBetween(-window, -1)
    judged = series.select(
        F.col(lot).alias("lot"), F.col(n).alias("n"),
        F.count(n).over(previous).alias("seen"), F.percentile(n, 0.5).over(previous).alias("median"),
    ).where(F.col("seen") >= history)
    ratio = F.coalesce(F.try_divide(F.col("n"), F.col("median")), F.lit(float("inf")))
    return (
        judged.withColumn("ratio", ratio)
        .where((F.col("ratio") > high) | (F.col("ratio") < low))
        .select("lot", "n", "median", F.round("ratio", 4).alias("ratio"))
    )


def without_full_load(batches: DataFrame, full: DataFrame, keys: Sequence[str] = EVENT_KEY, month: str = "mois") -> DataFrame:
    """Events of the batches, once each, minus those the full load already holds.

    Only months present on both sides can overlap, so the full load is read for
    those months only; a month filter from a subquery prunes its partitions.  Of these rows only
    those that a Bloom filter of the batches lets through are shuffled.
    """
    once = materialise(batches.groupBy(*keys, month).agg(F.count(F.lit(1)).alias("copies")), "batch-events")
    shared = once.select(month).distinct()
    held = may_hold(full.join(F.broadcast(shared), month, "left_semi").select(*keys), once, keys).distinct()
    return once.join(held, list(keys), "left_anti")


def differing_groups(stored: DataFrame, staged: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Staged groups that are new or whose values differ from the stored table."""
    old = stored.select(*keys, F.lit(True).alias("__known"), *[F.col(v).alias(f"__old_{v}") for v in values])
    joined = null_safe_join(staged, old, keys, "left")
    changed = F.lit(False)
    for v in values:
        changed = changed | ~F.col(v).eqNullSafe(F.col(f"__old_{v}"))
    kind = F.when(F.col("__known").isNull(), "nouveau").otherwise("modifie")
    return joined.where(F.col("__known").isNull() | changed).select(*keys, *values, kind.alias("kind"))


def merge_groups(stored: DataFrame, staged: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The stored table after an upsert of ``staged``: update, insert, never delete.

    Union and one aggregate in place of a full outer join: a single shuffle, and
    the staged row wins over the stored one.
    """
    tagged = stored.select(*keys, F.lit(0).alias("__new"), *values).unionByName(
        staged.select(*keys, F.lit(1).alias("__new"), *values)
    )
    latest = tagged.groupBy(*keys).agg(F.max(F.struct("__new", *values)).alias("__row"))
    return latest.select(*keys, *[F.col(f"__row.{v}").alias(v) for v in values])


def upsert(path: str, staged: DataFrame, keys: Sequence[str], values: Sequence[str], month: str = "mois") -> DataFrame:
    """Upsert into a stored table partitioned by month: update, insert, never delete; returns the groups that differed.

    Only the months of ``staged`` are read, only those with a difference are written again.  The names of the months pass through the
    driver, so that the scan is pruned by literals; the calendar bounds them.
    """
    spark = staged.sparkSession
    columns = [*keys, *values, *([month] if month not in keys else [])]
    by = [*keys, *([month] if month not in keys else [])]
    names = lambda df: [r[0] for r in df.select(month).distinct().collect()]
    staged = materialise(staged.select(*columns), "upsert-staged")
    stored = read_partitioned(spark, path).where(F.col(month).isin(names(staged))).select(*columns)
    changes = materialise(differing_groups(stored, staged, by, values), "upsert-changes")
    touched = stored.where(F.col(month).isin(names(changes)))
    merged = materialise(merge_groups(touched, changes, by, values), "upsert-merged")  # the months read are the months replaced
    write_rebalanced(merged.select(*columns), path, [month])
    return changes


def batch_statistics(df: DataFrame, day: str, month: str) -> DataFrame:
    """Manifest of a batch: per event month the rows, distinct days, first and last day."""
    return df.groupBy(month).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(day).alias("days"),
        F.min(day).cast("string").alias("first_day"), F.max(day).cast("string").alias("last_day"),
    )
