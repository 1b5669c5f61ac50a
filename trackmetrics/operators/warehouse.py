"""Star-schema queries and the tables they use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators.ranks import linear_quantile, value_ranks
from trackmetrics.operators.skew import null_safe_join



def engagement(history: DataFrame, user: str = "user_id", part: Sequence[str] = ()) -> DataFrame:
    """Per track: plays, distinct listeners, heaviest listener, loyal listeners, two ratios.

    ``part`` names columns that follow from the user.  Rows that lie together by track and those are counted where they lie.

    Two levels in place of ``count(DISTINCT)``: the inner group is (track, user),
    which is near unique, so a hot track reaches its final task as partial sums.
    """
    per_user = history.groupBy("track_id", *part, user).agg(
        F.sum("playcount").alias("p"), F.max("playcount").alias("m"), F.count_if(F.col("playcount") > 5).alias("l")
    )
    per_track = per_user.groupBy("track_id").agg(
        F.sum("p").cast("long").alias("total_plays"), F.count(user).alias("unique_listeners"),
        F.max("m").alias("max_playcount"), F.sum("l").alias("loyal_listeners"),
    )
    return per_track.withColumns({
        "plays_per_listener": F.round(F.try_divide(F.col("total_plays"), F.col("unique_listeners")), 4),
        "loyal_ratio": F.round(F.try_divide(F.col("loyal_listeners"), F.col("unique_listeners")), 4),
    })


def by_attribute(fact: DataFrame, dim: DataFrame, key: str, attribute: str, measures: Mapping[str, Column]) -> DataFrame:
    """Fact joined to a dimension and grouped by one attribute, nulls left out.

    The fact is summed per key before the join, so a key that holds a third of
    the fact is a single row there; measures must be counts or sums.
    """
    per_key = fact.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()])
    joined = per_key.join(dim.select(key, attribute).where(F.col(attribute).isNotNull()), key)
    return joined.groupBy(attribute).agg(*[F.sum(n).alias(n) for n in measures])


def top_groups(fact: DataFrame, key: str, measure: str, k: int, name: str) -> DataFrame:
    totals = fact.groupBy(key).agg(F.sum(measure).alias(name))
    return totals.orderBy(F.desc(name), key).limit(k)


def recent_top(facts: DataFrame, since: Column, k: int) -> DataFrame:
    return top_groups(facts.where(F.col("date") >= since), "msid", "listens", k, "listens")


def date_range(facts: DataFrame, first: str, end: str, day: str = "date", month: str = "mois") -> DataFrame:
    """Half-open range of days; the implied month range is added, so a table partitioned by month is pruned."""
    exact = (F.col(day) >= F.lit(first).cast("date")) & (F.col(day) < F.lit(end).cast("date"))
    last = F.date_format(F.date_sub(F.lit(end).cast("date"), 1), "yyyy-MM")
    return facts.where(exact & (F.col(month) >= first[:7]) & (F.col(month) <= last))


def replicate(df: DataFrame, user: str, factor: int) -> DataFrame:
    """``factor`` copies of every row; copy 0 keeps its user, the others get a derived one.

    ``explode`` of a constant sequence instead of a join with a range.
    """
    copied = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    derived = F.sha1(F.concat_ws("#", F.col(user), F.col("__copy").cast("string")))
    return copied.withColumn(user, F.when(F.col("__copy") == 0, F.col(user)).otherwise(derived)).drop("__copy")


def calendar(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """One row per day with year, quarter, month, ISO week, ISO weekday and weekend flag."""
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    weekday = (F.weekday("date") + 1).cast("int")
    return days.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        X.month_of(F.col("date")).alias("mois"), F.weekofyear("date").alias("week"),
        weekday.alias("weekday"), (weekday >= 6).alias("weekend"),
    )


def tag_origins(parts: Mapping[str, DataFrame], columns: list[str]) -> DataFrame:
    """UNION ALL of several tables with the name of the origin."""
    tagged = [df.select(F.lit(name).alias("origin"), *columns) for name, df in parts.items()]
    union = tagged[0]
    for df in tagged[1:]:
        union = union.unionByName(df)
    return union


def artist_reference(catalog: DataFrame, history: DataFrame, hit_at: Column | None = None) -> DataFrame:
    """Per artist: titles, plays, median plays, hits, summed listeners, years, main genre.

    ``listeners`` adds up titles, it is not a distinct count per artist.
    The main genre is that of the most played title that has one (ties: lowest
    track id).  Hits reach ``hit_at`` plays, by default the existing P75.
    """
    plays = engagement(history).select("track_id", "total_plays", "unique_listeners")
    genre = F.nullif(F.trim("genre"), F.lit(""))
    tracks = catalog.where(X.not_blank(F.col("artist"))).select("track_id", "artist", genre.alias("genre"), "year")
    tracks = tracks.join(plays, "track_id")
    if hit_at is None:
        from trackmetrics.operators.features import hit_threshold

        hit_at = hit_threshold(tracks, "total_plays")
    main = F.min(F.when(F.col("genre").isNotNull(), F.struct(-F.col("total_plays"), "track_id", "genre"))).getField("genre")
    hit = (F.col("total_plays") >= hit_at).cast("long")
    per_artist = tracks.withColumn("hit", hit).groupBy("artist").agg(
        n_rows().alias("titles"), F.sum("total_plays").alias("plays"), F.sum("hit").alias("hits"),
        F.round(F.lit(100.0) * F.sum("hit") / n_rows(), 2).alias("hit_pct"), F.sum("unique_listeners").alias("listeners"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count("genre").alias("titles_with_genre"), main.alias("main_genre"),
    )
    # The median comes from distributed ranks: an artist may own any number of titles.
    medians = value_ranks(tracks, "total_plays", ["artist"]).groupBy("artist").agg(
        linear_quantile(0.5).cast("long").alias("median_plays")
    )
    return null_safe_join(per_artist, medians, ["artist"], "left")
