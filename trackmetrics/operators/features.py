"""Feature table: label, leave-one-out artist features, leak diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.operators.catalog import AUDIO
from trackmetrics.operators.ranks import existing_quantile, value_ranks
from trackmetrics.operators.skew import attach

REFERENCE_YEAR = 2026
# Feature groups by kind of information; the last two leak the label.
GROUPS = {
    "A_audio": AUDIO,
    "B_context": ["age", "duration_min", "artist_other_titles"],
    "C_artist": ["artist_other_mean_plays", "artist_other_hit_rate"],
    "D_renown": ["nb_tags"],
    "E_engagement": ["unique_listeners", "plays_per_listener", "loyal_ratio", "max_playcount"],
    "F_target": ["total_plays", "log_total_plays", "is_hit"],
}
LEAK_FREE = ("A_audio", "B_context", "C_artist", "D_renown")


def hit_threshold(df: DataFrame, plays: str, q: float = 0.75) -> Column:
    """The play count a hit must reach: an existing value, as a scalar subquery."""
    return value_ranks(df, plays).agg(existing_quantile(q)).scalar()


def label(df: DataFrame, q: float = 0.75) -> DataFrame:
    year = F.col("year")
    return df.withColumns({
        "is_hit": (F.col("total_plays") >= hit_threshold(df, "total_plays", q)).cast("int"),
        "log_total_plays": F.round(F.log1p("total_plays"), 6),
        "age": F.when(year.isNotNull(), F.lit(REFERENCE_YEAR) - year),
    })


def leave_one_out(df: DataFrame) -> DataFrame:
    """Artist features that ignore the row's own track; null when the artist has one track.

    Sums per artist, attached back with hot artists split.  A null artist forms one group.
    """
    per_artist = df.groupBy("artist").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("total_plays").alias("__plays"), F.sum("is_hit").alias("__hits")
    )
    joined = attach(df, per_artist, ["artist"], "__n", ["track_id"])
    others = F.col("__n") - 1
    several = F.col("__n") > 1
    return joined.withColumns({
        "artist_other_titles": others,
        "artist_other_mean_plays": F.when(several, F.round((F.col("__plays") - F.col("total_plays")) / others, 2)),
        "artist_other_hit_rate": F.when(several, F.round((F.col("__hits") - F.col("is_hit")) / others, 4)),
    }).drop("__n", "__plays", "__hits")


def feature_table(catalog: DataFrame, engagement: DataFrame, q: float = 0.75) -> DataFrame:
    """Clean catalogue and engagement joined, labelled, in the order of the groups."""
    rows = leave_one_out(label(catalog.join(engagement, "track_id"), q))
    columns = ["track_id", "name", "artist", "genre", "year"]
    return rows.select(*columns, *[c for group in GROUPS.values() for c in group])


def candidates() -> list[str]:
    return [c for name, group in GROUPS.items() if name != "F_target" for c in group]


def group_of(variable: Column) -> Column:
    pairs = [F.lit(x) for name, group in GROUPS.items() for c in group for x in (c, name)]
    return F.try_element_at(F.create_map(*pairs), variable)


def identity_check(df: DataFrame, left: str, right: str, product: str) -> DataFrame:
    """Does left x right rebuild the target?  Largest and mean absolute difference."""
    gap = F.abs(F.col(left) * F.col(right) - F.col(product))
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(gap <= 0.5).alias("rebuilt"), F.round(F.max(gap), 3).alias("max_gap"),
    )


def fill_missing(df: DataFrame, columns: Sequence[str], sentinel: float = -1.0) -> DataFrame:
    """Sentinel for nulls plus an indicator column, only for columns that have nulls.

    Which columns have nulls decides the schema, so one aggregate is read by the driver: one row.
    """
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    holed = [c for c in columns if nulls[c]]
    return df.withColumns({
        **{f"{c}_missing": F.col(c).isNull().cast("int") for c in holed},
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(sentinel)) for c in holed},
    }) if holed else df
