"""Catalogue ingestion: declared schema, cleaning rules, bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from trackmetrics.functions import text as X
from trackmetrics.operators.skew import first_by

# Columns of the catalogue file, in file order.
CATALOG_SCHEMA = T.StructType(
    [T.StructField("track_id", T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in ("name", "artist", "spotify_preview_url", "spotify_id", "tags", "genre")]
    + [T.StructField(c, T.IntegerType()) for c in ("year", "duration_ms")]
    + [T.StructField(c, T.DoubleType()) for c in ("danceability", "energy")]
    + [T.StructField("key", T.IntegerType()), T.StructField("loudness", T.DoubleType()), T.StructField("mode", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in ("speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo")]
    + [T.StructField("time_signature", T.IntegerType()), T.StructField("_corrupt_record", T.StringType())]
)
AUDIO = (
    "danceability energy key loudness mode speechiness acousticness instrumentalness "
    "liveness valence tempo time_signature duration_ms"
).split()
# Documented range of each audio measure.
BOUNDS = {
    "danceability": (0.0, 1.0), "energy": (0.0, 1.0), "speechiness": (0.0, 1.0), "acousticness": (0.0, 1.0),
    "instrumentalness": (0.0, 1.0), "liveness": (0.0, 1.0), "valence": (0.0, 1.0), "loudness": (-60.0, 5.0),
    "tempo": (0.0, 250.0), "key": (-1, 11), "mode": (0, 1), "time_signature": (0, 7),
}


def clean_names(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "name": F.trim("name"), "artist": F.trim("artist"), "genre": F.lower(F.trim("genre")),
    })


def clean_catalog(df: DataFrame) -> DataFrame:
    """One row per usable track: key present, at least one audio measure, texts and sentinels cleaned."""
    usable = df.where(X.not_blank(F.col("track_id").cast("string"))).where(X.any_present(AUDIO))
    return clean_names(first_by(usable, ["track_id"])).withColumns({
        "year": X.real_year(F.col("year")),
        "duration_min": X.minutes(F.col("duration_ms")),
        "nb_tags": X.tag_count(F.col("tags")),
    })
