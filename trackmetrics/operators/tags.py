"""Tag vocabulary built from raw names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators.skew import lookup


def raw_names(tags: DataFrame, name: str = "nom", synonyms: DataFrame | None = None) -> DataFrame:
    """Raw spellings of each normal tag, one row per spelling, with the number of spellings.

    Rows in place of an array per tag: a tag may gather any number of spellings.
    """
    spellings = X.normalise_names(tags, name, synonyms).where(F.col("tag").isNotNull())
    sizes = spellings.groupBy("tag").agg(n_rows().alias("raw_names"))
    return lookup(spellings, sizes, "tag", [name])


def merges(spellings: DataFrame) -> DataFrame:
    """Tags that join several spellings."""
    return spellings.where(F.col("raw_names") > 1)


def item_tags(tags: DataFrame, item: str, name: str = "nom", votes: str = "votes", synonyms: DataFrame | None = None) -> DataFrame:
    """Votes per (item, normal tag), counting positive votes only.

    The normal form of a name is an expression of the row, so votes are shuffled once, by (item, tag).
    """
    positive = tags.where((F.col(votes) > 0) & F.col(name).isNotNull()).select(item, name, votes)
    formed = X.with_normal_form(positive, name).where(F.col("tag").isNotNull())
    named = formed.groupBy(item, "tag").agg(F.sum(votes).alias("votes"))
    if synonyms is None:
        return named
    pairs = synonyms.select(F.col("from_tag").alias("tag"), F.col("to_tag").alias("__to"))
    merged = lookup(named, pairs, "tag", [item]).withColumn("tag", F.nullif(F.coalesce("__to", "tag"), F.lit("")))
    return merged.where(F.col("tag").isNotNull()).groupBy(item, "tag").agg(F.sum("votes").alias("votes"))


def tag_statistics(per_item: DataFrame) -> DataFrame:
    return per_item.groupBy("tag").agg(n_rows().alias("items"), F.sum("votes").alias("votes"))


def threshold_counts(stats: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Size of the vocabulary at several thresholds, in one aggregate."""
    rows = [
        F.struct(F.lit("threshold").alias("what"), F.lit(str(n)).alias("tag"), F.count_if(F.col("items") >= n).alias("items"),
                 F.lit(None).cast("long").alias("votes"))
        for n in limits
    ]
    return stats.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def kept_items(per_item: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Item tags inside the vocabulary."""
    mark = vocabulary.select("tag", F.lit(True).alias("__kept"))
    items = [c for c in per_item.columns if c not in ("tag", "votes")]
    return lookup(per_item, mark, "tag", items).where(F.col("__kept")).drop("__kept")
