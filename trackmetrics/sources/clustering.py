"""Storage order over several columns: files that can be skipped by a condition on any of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Slots per column are 2 ** BITS; rows of one cell are told apart by the columns themselves.
BITS = 6


def slot_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Upper bounds of each column's slots, from approximate percentiles: equal shares of rows, not of values.

    One row of at most ``2 ** bits - 1`` values a column comes to the driver, whatever the table; columns are numbers, dates or timestamps.
    """
    shares = [F.lit(i / 2**bits) for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(c, F.array(*shares), 10_000).alias(c) for c in columns]).first()
    return {c: row[c] or [] for c in columns}


def slot(value: Column, bounds: Sequence, bits: int = BITS) -> Column:
    """Number of bounds below ``value``, by binary search.  Nulls, and all rows if there are no bounds, go to slot 0."""
    if not bounds:
        return F.lit(0)
    steps, limits = F.array(*[F.lit(2**i) for i in reversed(range(bits))]), F.array(*[F.lit(b) for b in bounds])
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(limits, at + step) < value, at + step).otherwise(at))
    return F.when(value.isNotNull(), place).otherwise(F.lit(0))


def interleave(slots: Sequence[Column], bits: int = BITS) -> Column:
    """Morton number: the bits of the slots in turn, highest first."""
    number = F.lit(0).cast("long")
    for bit in range(bits):
        for i, s in enumerate(slots):
            taken = F.shiftright(s, bit).bitwiseAND(F.lit(1)).cast("long")
            number = number.bitwiseOR(F.shiftleft(taken, bit * len(slots) + len(slots) - 1 - i))
    return number


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """Rows dealt over ``files`` parts along the Morton curve, sorted inside a part.

    One range shuffle.  A cell that holds many rows is cut further along the columns themselves, so a hot value of one column
    does not make a large file as long as the others differ.
    """
    bounds = slot_bounds(df, columns, bits)
    curve = interleave([slot(F.col(c), bounds[c], bits) for c in columns], bits)
    placed = df.withColumn("__curve", curve)
    return placed.repartitionByRange(files, "__curve", *columns).sortWithinPartitions("__curve", *columns).drop("__curve")


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and extreme values of each stored file of a file-backed table."""
    ends = [f(c).alias(f"{c}__{name}") for c in columns for name, f in (("low", F.min), ("high", F.max))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), *ends)


def touched(ranges: DataFrame, boxes: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    """Per box: files of the table and files that may hold a row of it.  A box names half-open ranges of some columns."""
    def meets(box):
        both = F.lit(True)
        for c, (low, high) in box.items():
            both = both & (F.col(f"{c}__low") < F.lit(high)) & (F.col(f"{c}__high") >= F.lit(low))
        return both

    counts = ranges.agg(F.count(F.lit(1)).alias("files"), *[F.count_if(meets(b)).alias(f"t_{name}") for name, b in boxes.items()])
    return counts.select("files", F.inline(F.array(*[F.struct(F.lit(n).alias("box"), F.col(f"t_{n}").alias("touched")) for n in boxes])))


def unsorted_share(ranges: DataFrame, key: str, part: Column) -> DataFrame:
    """Per partition value, percent of rows in files that begin before an earlier file ends: those a range on ``key`` rereads.

    ``ranges`` is :func:`file_ranges`; the windows hold the files of a partition, not its rows.
    """
    files = ranges.withColumn("part", part)
    earlier = Window.partitionBy("part").orderBy(f"{key}__low", f"{key}__high", "file").rowsBetween(Window.unboundedPreceding, -1)
    late = files.withColumn("late", F.coalesce(F.col(f"{key}__low") < F.max(f"{key}__high").over(earlier), F.lit(False)))
    return late.groupBy("part").agg(F.round(F.lit(100.0) * F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)) / F.sum("n"), 3).alias("unsorted_pct"))
