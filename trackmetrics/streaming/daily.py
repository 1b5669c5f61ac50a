"""Events and daily counts per title as a stream over arriving files.

Nothing is dropped for being late.  Which events were seen before is keyed state: the events of a bucket of a day, forgotten by a timer once
the newest event is more than ``late_days`` days ahead of the day.  Only events older than that are compared with what is
stored, and only with what is stored from before that bound.  An event received more than ``late_days`` days after its day goes to the
partition of old events.  Daily counts are kept as one part per micro-batch and added up by ``daily_counts``, so open days
are published too and no stored event is read again to count it.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators.incremental import LATE_DAYS, OLD, route_late
from trackmetrics.session import materialise
from trackmetrics.sources.layout import has_partitions, read_partitioned, write_rebalanced

EVENT_KEY = ["user_tok", "ts", "msid"]
EVENT_STATE = ["user_tok", "ts_us", "msid"]
DAY_MS = 86_400_000
#: Stands for the day of events without a time; they are old and keep no state.
NO_DAY = -1 << 40
#: Buckets of a day's events in the state; a bucket's events of the open days are held by one task at a time.
BUCKETS = 256
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_stream(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Events of a folder as a stream of listens, event time in UTC."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    return raw.select(
        F.md5(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user_tok"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("m"), F.get_json_object("props", "$.k")).alias("msid"),
    )


def _processor() -> StatefulProcessor:
    """Made inside a function, so that it travels to the workers by value."""

    def told(column: pd.Series) -> list[str]:
        """Texts that tell a missing value from an empty one: an array of the state does not keep nulls."""
        return ["" if gone else f"={value}" for value, gone in zip(column, column.isna())]

    def plain(events: pd.DataFrame) -> tuple[list, ...]:
        return told(events["user_tok"]), events["ts_us"].astype(object).tolist(), told(events["msid"])

    class FirstSeen(StatefulProcessor):
        """Gives out each event of a day's bucket once while its state lasts; events behind the watermark are given out as ``old``, for the caller to compare."""

        def init(self, handle) -> None:
            self.handle = handle
            # An entry per micro-batch, so that a new one does not write the earlier ones again.
            self.seen = handle.getListState("seen", "user_tok array<string>, ts_us array<bigint>, msid array<string>")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            newest = timerValues.getCurrentWatermarkInMs()
            found = pd.concat([r[EVENT_STATE] for r in rows], ignore_index=True).drop_duplicates()
            timeless = int(key[0]) == NO_DAY
            found["old"] = timeless | (found["ts_us"] // 1000 < newest)
            fresh = found[~found["old"]]
            if len(fresh) and self.seen.exists():
                known = set()
                for entry in self.seen.get():
                    known.update(zip(*entry))
                repeated = pd.Series([event in known for event in zip(*plain(fresh))], index=fresh.index, dtype=bool)
                found, fresh = found.drop(fresh.index[repeated]), fresh[~repeated]
            if len(fresh):
                self.seen.appendValue(plain(fresh))
                self.handle.registerTimer((int(key[0]) + 1) * DAY_MS)  # from then on all events of the day are old
            if len(found):
                times = pd.array([None] * len(found), "Int64") if timeless else found["ts_us"].astype("Int64")
                yield found.assign(ts_us=times, watermark_ms=newest)[[*EVENT_STATE, "watermark_ms", "old"]]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.seen.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FirstSeen()


def first_seen(events: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Stream of events not seen before, with the watermark they met.

    Events are dealt by a hash into ``BUCKETS`` buckets a day: a call of Python and of the state takes a bucket's events of a micro-batch,
    not one event.  The key is the day as a number, which carries no watermark: Spark would drop rows behind it, and these are wanted.
    """
    watched = events.withWatermark("ts", f"{late_days + 1} days").select("user_tok", F.unix_micros("ts").alias("ts_us"), "msid")
    day = F.coalesce(F.floor(F.col("ts_us") / F.lit(1000 * DAY_MS)), F.lit(NO_DAY)).cast("long")
    dealt = watched.withColumn("__day", day).withColumn("__bucket", F.pmod(F.xxhash64(*EVENT_STATE), F.lit(BUCKETS)).cast("int"))
    keyed = dealt.withColumn("ts_us", F.coalesce("ts_us", F.lit(0).cast("long")))  # one null would make floats of a batch's times
    return keyed.groupBy("__day", "__bucket").transformWithStateInPandas(
        statefulProcessor=_processor(), outputStructType="user_tok string, ts_us long, msid string, watermark_ms long, old boolean",
        outputMode="append", timeMode="eventTime",
    )


def _not_stored(old: DataFrame, store: str, months: list[str], bound: str, batch_id: int) -> DataFrame:
    """Old events that no other micro-batch stored; reads stored days up to the bound and the partition of old events, of their months."""
    stored = read_partitioned(old.sparkSession, store).where(F.col("mois").isin(months) & ((F.col("jour") == OLD) | (F.col("jour") <= bound)))
    known = stored.where(F.col("dump") != str(batch_id)).select("mois", *EVENT_KEY).alias("o")
    same = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in EVENT_KEY])
    return old.alias("n").join(known, (F.col("n.mois") == F.col("o.mois")) & same, "left_anti")


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """Keyed state with timers needs this provider; a stream copies the settings when it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def start_events(events: DataFrame, store: str, counts: str, checkpoint: str, late_days: int = LATE_DAYS):
    """Keep every event once under (mois, jour, dump) and the counts per title under (mois, date, dump).

    Reception is the latest event day seen so far, which the watermark carries from one micro-batch to the next.  A replayed
    micro-batch has the same number and the same state as at first, and replaces its own partitions, which makes both sinks exactly-once.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("ts", F.timestamp_micros("ts_us")).withColumn("date", F.to_date("ts")).withColumn("mois", X.month_of(F.col("date")))
        once = materialise(dated.select(*EVENT_KEY, "date", "mois", "watermark_ms", "old"), "micro-batch")
        months = F.collect_set(F.when(F.col("old"), F.col("mois")))  # bounded by the calendar
        seen = once.agg(F.max("date").alias("last"), F.max("watermark_ms").alias("watermark"), months.alias("old_months")).first()
        if seen["last"] is None:
            return
        bound = datetime.datetime.fromtimestamp(seen["watermark"] / 1000, datetime.timezone.utc).date()
        reception = max(seen["last"], bound + datetime.timedelta(days=late_days + 1))
        fresh = once.drop("watermark_ms")
        if seen["old_months"] and has_partitions(batch.sparkSession, store):
            old = _not_stored(fresh.where("old"), store, seen["old_months"], str(bound), batch_id)
            fresh = fresh.where("NOT old").unionByName(old)
        routed = route_late(fresh.drop("old").withColumn("reception", F.lit(reception)), "reception", "date", late_days)
        routed = materialise(routed.withColumn("dump", F.lit(batch_id)), "routed")
        write_rebalanced(routed, store, ["mois", "jour", "dump"])
        write_rebalanced(routed.groupBy("mois", "date", "msid", "dump").agg(n_rows().alias("listens")), counts, ["mois", "date", "dump"])

    with _state_in_rocksdb(events.sparkSession):
        return first_seen(events, late_days).writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Counts per day and title over all micro-batches."""
    return read_partitioned(spark, counts).groupBy("mois", "date", "msid").agg(F.sum("listens").alias("listens"))
