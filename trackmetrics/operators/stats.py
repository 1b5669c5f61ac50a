"""Comparison statistics between two sources: agreement, concentration, shares, alternative targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.operators.ranks import linear_quantile, spearman, value_ranks


def contingency(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """2x2 table of two yes/no columns, observed agreement and Cohen's kappa (0 when chance agreement is 1)."""
    t = df.agg(
        F.count_if(a & b).alias("n11"), F.count_if(a & ~b).alias("n10"),
        F.count_if(~a & b).alias("n01"), F.count_if(~a & ~b).alias("n00"),
    )
    n11, n10, n01, n00 = (F.col(c).cast("double") for c in ("n11", "n10", "n01", "n00"))
    n = n11 + n10 + n01 + n00
    observed = F.try_divide(n11 + n00, n)
    chance = F.try_divide((n11 + n10) * (n11 + n01) + (n01 + n00) * (n10 + n00), n * n)
    kappa = F.when(chance < 1, (observed - chance) / (F.lit(1.0) - chance)).otherwise(0.0)
    return t.select("n11", "n10", "n01", "n00", F.round(observed, 4).alias("observed"), F.round(kappa, 4).alias("kappa"))


def concentration(df: DataFrame, value: str) -> DataFrame:
    """Quantiles of a measure and the share of its total held by the top 1 % of rows (at least one)."""
    ranked = value_ranks(df, value, carry={"mass": F.col(value).cast("double")})
    top = F.greatest(F.lit(1), F.floor(F.col("total") / 100))
    # Rows of this value that fall among the last `top` positions.
    taken = F.greatest(F.lit(0), F.least(F.col("n"), F.col("upto") - (F.col("total") - top)))
    quantiles = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p99": 0.99}
    share = F.try_divide(F.sum(F.col("value").cast("double") * taken), F.sum("mass"))
    return ranked.agg(
        F.max("total").alias("n"),
        *[F.round(linear_quantile(q), 4).alias(name) for name, q in quantiles.items()],
        F.max("value").cast("double").alias("maximum"),
        F.round(F.lit(100.0) * share, 2).alias("top1_pct"),
    )


def shares(df: DataFrame, category: str, left: str, right: str) -> DataFrame:
    """Share of two measures per category, and their ratio.

    Totals are scalar subqueries, not a window over all categories.
    """
    sums = df.groupBy(category).agg(n_rows().alias("titles"), F.sum(left).alias("l"), F.sum(right).alias("r"))
    total_l, total_r = sums.agg(F.sum("l")).scalar(), sums.agg(F.sum("r")).scalar()
    share_l, share_r = F.try_divide(F.col("l"), total_l), F.try_divide(F.col("r"), total_r)
    return sums.select(category, "titles", share_l.alias("left_share"), share_r.alias("right_share"),
                       F.try_divide(share_r, share_l).alias("ratio"))


def total_variation(shared: DataFrame) -> DataFrame:
    gap = F.abs(F.coalesce("left_share", F.lit(0.0)) - F.coalesce("right_share", F.lit(0.0)))
    return shared.agg(n_rows().alias("categories"), F.round(F.lit(0.5) * F.sum(gap), 4).alias("tvd"))


def share_extremes(shared: DataFrame, category: str, min_titles: int, k: int) -> DataFrame:
    """The k categories most over- and under-represented, among those with enough titles."""
    kept = shared.where((F.col("titles") >= min_titles) & (F.col("left_share") > 0) & (F.col("right_share") > 0))
    over = kept.orderBy(F.desc("ratio"), category).limit(k).withColumn("side", F.lit("over"))
    under = kept.orderBy("ratio", category).limit(k).withColumn("side", F.lit("under"))
    return over.unionByName(under)


def share_rank_correlation(shared: DataFrame, min_titles: int) -> DataFrame:
    kept = shared.where((F.col("titles") >= min_titles) & (F.col("left_share") > 0) & (F.col("right_share") > 0))
    return spearman(kept, "left_share", "right_share")


def threshold(df: DataFrame, value: str, q: float = 0.75) -> Column:
    """Interpolated quantile as a scalar subquery."""
    return value_ranks(df, value).agg(linear_quantile(q)).scalar()


def alternative_targets(labelled: DataFrame, other: DataFrame, measure: str) -> DataFrame:
    """Second label from another source: P75 over the common titles and over all found titles.

    ``labelled`` has (track_id, total_plays, is_hit); ``other`` has (track_id, measure).
    """
    found = other.join(labelled, "track_id", "left")
    common = found.where(F.col("is_hit").isNotNull())
    at_common, at_found = threshold(common, measure), threshold(found, measure)
    return found.select(
        "track_id", "total_plays", "is_hit", measure,
        F.when(F.col("is_hit").isNotNull(), (F.col(measure) >= at_common).cast("int")).alias("is_hit_common"),
        (F.col(measure) >= at_found).cast("int").alias("is_hit_found"),
    )
