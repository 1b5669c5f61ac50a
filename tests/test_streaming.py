"""The stream: late and repeated events, open days, restart after a stop."""

import datetime

from trackmetrics.sources.layout import read_partitioned
from trackmetrics.streaming import daily as ST

SCHEMA = "user_id long, ts timestamp_ntz, props string"


def add(spark, folder, rows):
    data = [(u, datetime.datetime.fromisoformat(ts), f'{{"k": {k}}}') for u, ts, k in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


class Run:
    def __init__(self, spark, base):
        self.spark = spark
        self.folder, self.store, self.counts, self.state = (str(base / n) for n in ("in", "store", "counts", "state"))

    def take(self, *rows):
        if rows:
            add(self.spark, self.folder, rows)
        ST.start_events(ST.event_stream(self.spark, self.folder, "*.parquet"), self.store, self.counts, self.state).awaitTermination()

    def counted(self):
        return {(str(r["date"]), r["msid"]): r["listens"] for r in ST.daily_counts(self.spark, self.counts).collect()}

    def stored(self):
        return sorted((str(r["ts"].date()), r["jour"]) for r in read_partitioned(self.spark, self.store).collect())


def test_no_event_is_lost_or_counted_twice(spark, tmp_path):
    run = Run(spark, tmp_path)
    run.take((1, "2024-01-01T10:00:00", 5), (1, "2024-01-01T10:00:00", 5), (2, "2024-01-01T11:00:00", 5))
    assert run.counted() == {("2024-01-01", "m5"): 2}  # an open day is published
    run.take((3, "2024-01-01T12:00:00", 5), (1, "2024-01-01T10:00:00", 5), (4, "2024-01-02T09:00:00", 5))
    assert run.counted() == {("2024-01-01", "m5"): 3, ("2024-01-02", "m5"): 1}
    run.take((9, "2024-03-20T00:00:00", 6))
    run.take((8, "2024-01-01T13:00:00", 5), (8, "2024-03-01T13:00:00", 5), (2, "2024-01-01T11:00:00", 5))
    assert run.counted()[("2024-01-01", "m5")] == 4 and run.counted()[("2024-03-01", "m5")] == 1
    late = [x for x in run.stored() if x[1] == "_ancien"]
    assert late == [("2024-01-01", "_ancien")]  # the far too late event is kept apart
    before = run.stored()
    run.take()  # nothing new
    assert run.stored() == before and len(before) == 7


def test_repeats_inside_the_bound_are_known_from_state(spark, tmp_path):
    """Stored days inside the bound are emptied between micro-batches: nothing reads them, and a restart keeps the state."""
    run = Run(spark, tmp_path)
    run.take((1, "2024-01-10T10:00:00", 5), (2, "2024-01-11T11:00:00", 5))
    for path in (tmp_path / "store").rglob("*.parquet"):
        path.write_bytes(b"unreadable")
    run.take((1, "2024-01-10T10:00:00", 5), (2, "2024-01-11T11:00:00", 5), (3, "2024-01-12T11:00:00", 5))
    assert run.counted() == {("2024-01-10", "m5"): 1, ("2024-01-11", "m5"): 1, ("2024-01-12", "m5"): 1}


def test_old_events_are_compared_with_what_is_stored(spark, tmp_path):
    """State of an event is forgotten behind the bound; its repeats are then found in the store, wherever the event went."""
    run = Run(spark, tmp_path)
    run.take((1, "2024-01-10T10:00:00", 5))
    run.take((2, "2024-06-01T10:00:00", 5))
    run.take((1, "2024-01-10T10:00:00", 5), (3, "2024-01-10T11:00:00", 5))
    run.take((1, "2024-01-10T10:00:00", 5), (3, "2024-01-10T11:00:00", 5), (2, "2024-06-01T10:00:00", 5))
    assert run.counted() == {("2024-01-10", "m5"): 2, ("2024-06-01", "m5"): 1}
    assert run.stored() == [("2024-01-10", "2024-01-10"), ("2024-01-10", "_ancien"), ("2024-06-01", "2024-06-01")]


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    """A stop after the sinks and before the commit: the micro-batch runs again with the same number and state."""
    run = Run(spark, tmp_path)
    run.take((1, "2024-01-10T10:00:00", 5), (2, "2024-01-11T11:00:00", 6))
    run.take((1, "2024-01-10T10:00:00", 5), (3, "2024-01-12T11:00:00", 5))
    before = run.counted(), run.stored()
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run.take()
    assert (run.counted(), run.stored()) == before


def test_state_has_a_row_per_bucket_and_not_per_event(spark, tmp_path):
    """One call of the processor takes a bucket's events; repeats of a later micro-batch are found among all entries of the bucket."""
    run = Run(spark, tmp_path)
    events = [(u, f"2024-01-10T10:{u % 60:02d}:00", 5) for u in range(4 * ST.BUCKETS)]
    add(spark, run.folder, events)
    query = ST.start_events(ST.event_stream(spark, run.folder, "*.parquet"), run.store, run.counts, run.state)
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(kept) <= 2 * ST.BUCKETS
    run.take(*events[:100], (9_999, "2024-01-10T12:00:00", 5))
    run.take(*events[50:150], (9_999, "2024-01-10T12:00:00", 5))
    assert run.counted() == {("2024-01-10", "m5"): 4 * ST.BUCKETS + 1}


def test_events_without_user_title_or_time_are_kept_once(spark, tmp_path):
    run = Run(spark, tmp_path)
    rows = [(None, datetime.datetime(2024, 1, 10), '{"k": 5}'), (1, datetime.datetime(2024, 1, 10), "{}"), (1, datetime.datetime(1960, 1, 1, 5), '{"k": 5}')]
    timeless = (1, None, '{"k": 5}')  # comes in one micro-batch only: it has no month whose stored events it could be compared with
    spark.createDataFrame([*rows, timeless] * 2, SCHEMA).coalesce(1).write.parquet(run.folder)
    for _ in range(2):
        run.take()
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(run.folder)
    assert run.counted() == {("2024-01-10", "m5"): 1, ("2024-01-10", None): 1, ("1960-01-01", "m5"): 1, ("None", "m5"): 1}
