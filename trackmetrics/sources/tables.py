"""Catalog tables over written files: registration, properties, partition maintenance."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmetrics.sources.layout import delete_folders


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", name):
        raise ValueError(f"not a table name: {name}")
    return name


def unique_name(prefix: str) -> str:
    """A table name of its own, so that sessions that share a catalog do not replace each other's tables."""
    return f"{prefix}_{uuid.uuid4().hex}"


def register(
    spark: SparkSession, name: str, path: str, comment: str, properties: Mapping[str, str], partitions: Sequence[str] = ()
) -> str:
    """Create or replace an external Parquet table with explicit columns, a comment and properties.

    The columns come from the files, so positions cannot drift.  Returns the name.
    """
    name = _identifier(name)
    schema = spark.read.option("mergeSchema", "false").parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    props = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION {_quoted(path)} COMMENT {_quoted(comment)}"
        + (f" TBLPROPERTIES ({props})" if props else "")
    )
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def update_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    props = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {_identifier(name)} SET TBLPROPERTIES ({props})")


def check_properties(spark: SparkSession, name: str, wanted: Mapping[str, str]) -> DataFrame:
    """Required properties with the stored value and whether it is exact, beside the table's row count."""
    stored = spark.sql(f"SHOW TBLPROPERTIES {_identifier(name)}")
    required = spark.createDataFrame(list(wanted.items()), "key string, wanted string")
    n = spark.table(name).agg(F.count(F.lit(1))).scalar()
    joined = required.join(stored, "key", "left")
    return joined.select("key", "wanted", "value", F.col("wanted").eqNullSafe(F.col("value")).cast("int").alias("ok"), n.alias("table_rows"))


def drop_partitions_before(spark: SparkSession, name: str, column: str, limit: str) -> int:
    """Retention: drop the partitions of a dated column that lie before ``limit`` and delete their files; returns how many.

    The table is external, so the catalog alone would keep the files.  Partition names are catalog metadata, one per day; the
    folders are deleted first, so that an interrupted run is finished by the next one.
    """
    pattern = rf"(?:^|/){_identifier(column)}=([^/]+)"
    listed = spark.sql(f"SHOW PARTITIONS {_identifier(name)}").select("partition", F.regexp_extract("partition", pattern, 1).alias("v"))
    old = listed.where(F.col("v") < limit).collect()
    if old:
        base = next(r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect() if r["col_name"] == "Location")
        delete_folders(spark, [f"{base.rstrip('/')}/{r['partition']}" for r in old])
        specs = ", ".join(f"PARTITION ({column} = {_quoted(v)})" for v in sorted({r["v"] for r in old}))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        spark.sql(f"REFRESH TABLE {name}")
    return len(old)
