"""Exact ranks and quantiles without a single-task sort.

The base is one table, :func:`value_ranks`: the distinct values of a column with
their frequency and cumulative frequency.  Rows are first reduced to (value, n),
which removes any hot value, then placed in value slots cut by an approximate
percentile.  The cumulative sum is taken inside a slot and shifted by the total
of the slots below, so no task sees more than one slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.operators.skew import null_safe_join

SLOTS = 256


def _cuts_below(slots: int) -> Column:
    """Number of entries of the sorted ``__cuts`` below ``value``, by binary search."""
    steps = [1 << i for i in reversed(range(slots.bit_length()))]

    def advance(at: Column, step: Column) -> Column:
        return F.when(F.get("__cuts", at + step - 1) < F.col("value"), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def value_ranks(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    weight: Column | None = None,
    carry: dict[str, Column] | None = None,
    slots: int = SLOTS,
) -> DataFrame:
    """Columns: ``by``, ``value``, ``n``, ``upto`` (rows <= value in the group), ``total``.

    ``carry`` adds summed columns per value, each with its own running sum ``<name>_upto``.
    """
    by, carry = list(by), carry or {}
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("value"))
        .agg(size.alias("n"), *[F.sum(c).alias(name) for name, c in carry.items()])
    )
    probabilities = [i / slots for i in range(1, slots)]
    cuts = counts.agg(F.percentile_approx("value", probabilities, 20 * slots)).scalar()
    placed = counts.withColumn("__cuts", cuts).withColumn("__slot", _cuts_below(slots)).drop("__cuts")

    sums = ["n", *carry]
    per_slot = placed.groupBy(*by, "__slot").agg(*[F.sum(c).alias(f"__s_{c}") for c in sums])
    # At most `slots` rows per group, so this window is bounded by construction.
    below = Window.partitionBy(*by).orderBy("__slot")
    everything = Window.partitionBy(*by)
    offsets = per_slot.select(
        *by,
        "__slot",
        *[(F.sum(f"__s_{c}").over(below) - F.col(f"__s_{c}")).alias(f"__b_{c}") for c in sums],
        F.sum("__s_n").over(everything).alias("total"),
    )
    inside = Window.partitionBy(*by, "__slot").orderBy("value")
    running = placed.select(*placed.columns, *[F.sum(c).over(inside).alias(f"__w_{c}") for c in sums])
    if not by:
        offsets = F.broadcast(offsets)  # at most `slots` rows
    joined = null_safe_join(running, offsets, [*by, "__slot"])
    return joined.select(
        *by,
        "value",
        "n",
        (F.col("__b_n") + F.col("__w_n")).alias("upto"),
        *[c for name in carry for c in (F.col(name), (F.col(f"__b_{name}") + F.col(f"__w_{name}")).alias(f"{name}_upto"))],
        "total",
    )


def at_index(index: Column) -> Column:
    """Aggregate over :func:`value_ranks`: the value at a zero-based sorted position."""
    return F.min(F.when(F.col("upto") > index, F.col("value")))


def existing_quantile(q: float) -> Column:
    """Aggregate over :func:`value_ranks`: smallest value reached by a share ``q`` of the rows."""
    return F.min(F.when(F.col("upto") >= F.ceil(F.round(F.lit(q) * F.col("total"), 9)), F.col("value")))


def linear_quantile(q: float) -> Column:
    """Aggregate over :func:`value_ranks`: quantile interpolated between the two neighbouring values."""
    position = F.lit(q) * (F.col("total") - 1)
    low = F.floor(position)
    lower = at_index(low).cast("double")
    upper = at_index(F.least(low + 1, F.col("total") - 1)).cast("double")
    fraction = F.max(position - low)
    return lower + (upper - lower) * fraction


def quantiles(df: DataFrame, value: str, wanted: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per group with the requested quantile aggregates."""
    ranked = value_ranks(df, value, by)
    aggregates = [c.alias(name) for name, c in wanted.items()]
    return ranked.groupBy(*by).agg(*aggregates) if by else ranked.agg(*aggregates)


def average_rank() -> Column:
    """Rank shared by equal values: the mean of the positions they occupy."""
    return F.col("upto") - (F.col("n") - 1) / 2


def spearman(df: DataFrame, left: str, right: str, name: str = "rho", by: Sequence[str] = ()) -> DataFrame:
    """Rank correlation with average ranks for ties; works on distinct (left, right) pairs with their count."""
    by = list(by)
    pairs = (
        df.where(F.col(left).isNotNull() & F.col(right).isNotNull())
        .groupBy(*by, F.col(left).alias("__x"), F.col(right).alias("__y"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    def ranks(column: str, out: str) -> DataFrame:
        return value_ranks(pairs, column, by, weight=F.col("__n")).select(
            *by, F.col("value").alias(column), average_rank().alias(out)
        )
    ranked = null_safe_join(pairs, ranks("__x", "__rx"), [*by, "__x"])
    ranked = null_safe_join(ranked, ranks("__y", "__ry"), [*by, "__y"])
    w, x, y = F.col("__n"), F.col("__rx"), F.col("__ry")
    sums = ranked.groupBy(*by).agg(
        F.sum(w).cast("double").alias("n"),
        F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
        F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"), F.sum(w * x * y).alias("sxy"),
    )
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    rho = F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy)).otherwise(F.lit(0.0))
    return sums.select(*by, F.col("n").cast("long").alias("pairs"), rho.alias(name))
