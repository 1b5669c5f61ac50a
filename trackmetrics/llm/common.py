"""Helpers that several operators share: connected components, numbering within groups, checked broadcasts."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.session import materialise

# A table of at most this many rows of a few numbers (some 20 MB) may be broadcast; its size is counted first, and so are the
# bytes of columns without a fixed width.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, width: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint when a count shows at most ``limit`` rows, whose ``width`` sums to at most BROADCAST_BYTES; otherwise unchanged, so that joins shuffle."""
    if df.limit(limit + 1).count() > limit:
        return df
    if width is not None and (df.agg(F.sum(width)).first()[0] or 0) > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, spread: Sequence[str]) -> DataFrame:
    """Add a gapless number from 0 within each key, without bringing a key's rows into one task.

    Rows of a key are dealt into buckets by a hash of ``spread``; rows are
    numbered inside a bucket, and a bucket starts where the buckets before it end.
    """
    buckets = max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*spread), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    rows = dealt.withColumn("__row", F.row_number().over(inside))
    joined = rows.join(starts, [*keys, "__bucket"])
    return joined.select(*df.columns, (F.col("__start") + F.col("__row") - 1).cast("long").alias(out))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the edges (a, b): one row (node, component) per node, component = smallest node.

    Alternating large-star and small-star steps; each step is a minimum per
    node (combined on the map side) joined back to the edges, so a node with very many
    neighbours is a skewed join at worst, which adaptive execution splits.
    """
    u, v = F.col("u"), F.col("v")
    current = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name
    )
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return current.select(u.alias("node"), v.alias("component")).unionByName(
                current.select(v.alias("node"), v.alias("component")).distinct()
            )
        seen = tuple(state)
        if not state[0]:
            return current.select(u.alias("node"), v.alias("component"))
        both = current.unionByName(current.select(v.alias("u"), u.alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(v.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(lowest, "u")
        small = joined.select("v", "m").where("v <> m").select(v.alias("u"), F.col("m").alias("v"))
        current = materialise(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), name)


def merge_labels(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (indices of members) after joining the sets of members x[i] and y[i]; a set is labelled by its smallest label.

    The number of rounds follows the length of chains of links, not their number.
    """
    while True:
        low = np.minimum(labels[x], labels[y])
        new = labels.copy()
        np.minimum.at(new, labels[x], low)
        np.minimum.at(new, labels[y], low)
        new = new[new[labels]]
        if (new == labels).all():
            return labels
        labels = new


def give_back() -> None:
    """Return what a worker still holds for earlier stages: tables of encoded pieces, and freed buffers the allocators keep."""
    bpe = sys.modules.get("trackmetrics.llm.bpe")
    if bpe is not None:
        bpe.release()
    trim()


def trim() -> None:
    """Return freed buffers that the allocators keep."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable) -> Callable:
    """A function for mapInArrow that gives memory back before and after: Python workers are reused from stage to stage."""

    def wrapped(batches):
        give_back()
        yield from run(batches)
        give_back()

    return wrapped


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
