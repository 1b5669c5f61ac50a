"""Column expressions for names, tags, identifiers and formats."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Identifier formats and labels that stored results use.
HEX32 = "^[0-9a-f]{32}$"
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ASCII = r"^[\x00-\x7F]*$"
# ASCII and the Latin letters that NFKC leaves as they are.
COMPOSED = r"^[\x00-\x7F\u00C0-\u00FF]*$"
# The ways an external track id is written, and the label of each.
TRACK_ID = "[0-9A-Za-z]{22}"
TRACK_FORMS = {
    "url_track": rf"^https?://open\.spotify\.com/track/{TRACK_ID}",
    "uri_track": f"^spotify:track:{TRACK_ID}$",
    "nu_22": f"^{TRACK_ID}$",
}
MISSING_LABELS = ("nan", "none", "null")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.length(F.trim(c)) > 0)


def ascii_key(*parts: Column) -> Column:
    """Match key of the joined texts: null unless all ASCII, else lower-case letters, digits and ``_``."""
    joined = F.concat_ws("", *parts)
    one_byte_each = F.octet_length(joined) == F.char_length(joined)
    return F.when(one_byte_each, F.nullif(F.regexp_replace(F.lower(joined), r"\W+", ""), F.lit("")))


def spotify_format(c: Column) -> Column:
    """Label of the form in which an external id is written."""
    labels = [F.when(c.rlike(pattern), label) for label, pattern in TRACK_FORMS.items()]
    return F.coalesce(*labels, F.when(c.isNull(), "absent"), F.lit("autre"))


def spotify_track(c: Column) -> Column:
    """The bare id of a track: the whole text, or what follows the word that introduces it."""
    return F.nullif(F.regexp_extract(c, f"(?:^(?={TRACK_ID}$)|track[/:])({TRACK_ID})", 1), F.lit(""))


def real_year(year: Column) -> Column:
    """The source writes unknown years as 0."""
    return F.when(year > 1900, year)


def decade(year: Column) -> Column:
    known = F.concat(F.floor(year / 10).cast("string"), F.lit("0s"))
    return F.when(year.isNull() | (year <= 0), F.lit("inconnue")).otherwise(known)


def genre_label(genre: Column) -> Column:
    bare = F.lower(F.trim(genre))
    missing = genre.isNull() | (bare == "") | bare.isin(*MISSING_LABELS)
    return F.when(missing, F.lit("(absent)")).otherwise(genre)


def tag_count(tags: Column) -> Column:
    return F.when(tags.isNull(), F.lit(0)).otherwise(F.size(F.split(tags, ",")))


def minutes(milliseconds: Column) -> Column:
    return F.round(milliseconds / F.lit(60000.0), 3)


@F.pandas_udf(T.StringType())
def _nfkc(names: pd.Series) -> pd.Series:
    return names.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def decode_copy(c: Column) -> Column:
    """Undo the backslash escapes of a database text dump, left to right."""
    marker = "\ue000"  # private-use character standing for an escaped backslash
    c = F.replace(c, F.lit("\\\\"), F.lit(marker))
    for letter, character in (("t", "\t"), ("n", "\n"), ("r", "\r"), ("b", "\b"), ("f", "\f"), ("v", "\v")):
        c = F.replace(c, F.lit("\\" + letter), F.lit(character))
    return F.replace(c, F.lit(marker), F.lit("\\"))


def _tidy(c: Column) -> Column:
    c = F.replace(F.lower(c), F.lit("&"), F.lit(" and "))
    c = F.regexp_replace(c, r"[/\-_]+", " ")
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalise_names(names: DataFrame, name: str, synonyms: DataFrame | None = None, out: str = "tag") -> DataFrame:
    """Distinct names with their normal form; the form is null for names that vanish.

    ``synonyms`` has columns (from_tag, to_tag), both already normal.  Python runs
    only on the distinct names that hold a non-ASCII character.
    """
    distinct = names.where(F.col(name).isNotNull()).select(name).distinct()
    distinct = distinct.withColumn("__text", decode_copy(F.col(name)))
    plain = F.col("__text").rlike(ASCII)
    folded = distinct.where(plain).unionByName(distinct.where(~plain).withColumn("__text", _nfkc("__text")))
    tidy = folded.select(name, _tidy(F.col("__text")).alias(out))
    if synonyms is not None:
        pairs = synonyms.select(F.col("from_tag").alias(out), F.col("to_tag").alias("__to"))
        tidy = tidy.join(pairs, out, "left").select(name, F.coalesce("__to", out).alias(out))
    return tidy.select(name, F.nullif(F.col(out), F.lit("")).alias(out))


def with_normal_form(rows: DataFrame, name: str, out: str = "tag") -> DataFrame:
    """Rows with the normal form of a name, as :func:`normalise_names` gives it without synonyms, and no shuffle.

    Python sees only the rows whose name NFKC may change.
    """
    read = rows.withColumn("__text", decode_copy(F.col(name)))
    plain = F.col("__text").rlike(COMPOSED)
    folded = read.where(plain).unionByName(read.where(~plain).withColumn("__text", _nfkc("__text")))
    return folded.withColumn(out, F.nullif(_tidy(F.col("__text")), F.lit(""))).drop("__text")


def any_present(columns: Sequence[str]) -> Column:
    """True unless every column is null."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()


def first_with_origin(candidates: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-null of several sources, and the name of the source it came from."""
    value = F.coalesce(*[c for _, c in candidates])
    origin = F.when(candidates[0][1].isNotNull(), candidates[0][0])
    for name, c in candidates[1:]:
        origin = origin.when(c.isNotNull(), name)
    return value, origin


def scalar_or_list(*candidates: Column | tuple[Column]) -> Column:
    """First non-null list; a candidate given as a 1-tuple is a scalar and becomes a one-element list."""
    lists = [F.when(c[0].isNotNull(), F.array(c[0])) if isinstance(c, tuple) else c for c in candidates]
    return F.coalesce(*lists)


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def day_of(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))


def day_from_text(text: str) -> date:
    return date.fromisoformat(text)
