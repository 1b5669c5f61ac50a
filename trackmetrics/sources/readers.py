"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"


def csv_permissive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; an unreadable line is kept in ``_corrupt_record``."""
    if CORRUPT not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    )


def csv_by_name(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """CSV read as text, required names checked, then cast; a value that does not fit becomes null."""
    text = spark.read.option("header", True).csv(path)
    missing = sorted(set(types) - set(text.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}; found {text.columns}")
    return text.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()])


def csv_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reference CSV: quoted fields may hold line breaks, any malformed record stops the read."""
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"')
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def json_partial(spark: SparkSession, path: str, schema: str, base: str | None = None, corrupt: str = CORRUPT) -> DataFrame:
    """JSON lines parsed for the named fields only; broken lines are kept in the corrupt column."""
    reader = spark.read.schema(f"{schema}, {corrupt} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    if base:
        reader = reader.option("basePath", base)
    return reader.json(path)


def text_lines(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """Raw lines (``value``) with the partition columns below ``base``."""
    reader = spark.read.option("basePath", base) if base else spark.read
    return reader.text(path)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One multi-line JSON document per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def config_text(spark: SparkSession, path: str) -> str:
    """Content of one small configuration file (a contract, a synonym table)."""
    return spark.read.text(path, wholetext=True).first()[0]


def tsv(spark: SparkSession, path: str, types: Mapping[str, str]) -> DataFrame:
    """Tab-separated text; ``ok`` tells whether the line has the right number of columns.

    Lines of another width are kept with null columns, to be counted or stored.
    """
    lines = spark.read.text(path)
    parts = F.split("value", "\t")
    ok = F.size(parts) == len(types)
    columns = [F.when(ok, parts[i]).try_cast(t).alias(c) for i, (c, t) in enumerate(types.items())]
    return lines.select(*columns, ok.alias("ok"), "value")


def tsv_columns(spark: SparkSession, path: str, wanted: Mapping[int, str]) -> DataFrame:
    """A few columns of a wide tab-separated dump, by position, with the line's field count."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(*[F.get(parts, i).alias(c) for i, c in wanted.items()], F.size(parts).alias("fields"))


def with_batch(df: DataFrame, pattern: str = r"dump=([^/]+)", name: str = "dump") -> DataFrame:
    """Batch id taken from the path of the file a row comes from."""
    return df.withColumn(name, F.regexp_extract("_metadata.file_path", pattern, 1))


def existing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in df.columns]
