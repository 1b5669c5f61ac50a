"""Structure survey of JSON lines: which paths hold which types, since when."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.session import materialise


def _kind(v: Column) -> Column:
    """Type of a variant value without its inner structure."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _open(path: Column, v: Column, known: Column) -> Column:
    """One step of the walk: a leaf stays, an object becomes its members, a list itself and its items."""
    kind, nothing = _kind(v), F.lit(None)

    def entry(at: Column, value: Column, of: Column) -> Column:
        return F.struct(at.alias("path"), value.cast("variant").alias("v"), of.cast("string").alias("type"))

    members = F.transform(
        F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")),
        lambda m: entry(F.when(path == "", m["key"]).otherwise(F.concat(path, F.lit("."), m["key"])), m["value"], nothing),
    )
    items = F.transform(
        F.try_variant_get(v, "$", "array<variant>"), lambda x: entry(F.concat(path, F.lit("[]")), x, nothing)
    )
    return (
        F.when(known.isNotNull(), F.array(entry(path, nothing, known)))
        .when(kind == "OBJECT", members)
        .when(kind == "ARRAY", F.concat(F.array(entry(path, nothing, kind)), items))
        .otherwise(F.array(entry(path, nothing, kind)))
    )


def survey(lines: DataFrame, line: str, month: str = "mois") -> DataFrame:
    """Per (path, type): lines that hold it, first and last month.

    Objects and lists are opened one level per step until none is left; each step is stored, and the next one reads only
    what is still closed.  Only paths inside lists can repeat in a line and need a distinct.
    """
    walk = lines.select(line, month, F.lit("").alias("path"), F.try_parse_json("value").alias("v"), F.lit(None).cast("string").alias("type"))
    closed, parts = walk.where(F.col("v").isNotNull()), []
    while True:
        opened = closed.select(line, month, F.explode(_open(F.col("path"), F.col("v"), F.col("type"))).alias("x"))
        step = materialise(opened.select(line, month, "x.path", "x.v", "x.type"), "survey")
        parts.append(step.where(F.col("type").isNotNull()).select(line, month, "path", "type"))
        closed = step.where(F.col("type").isNull())
        if closed.limit(1).count() == 0:
            break
    found = reduce(DataFrame.unionByName, parts)
    # Paths outside lists are counted as they are; list paths first lose their repeats within a line.
    inside = F.when(F.col("path").contains("[]"), F.col(line))
    per_line = found.groupBy("path", "type", month, inside.alias("__line")).agg(n_rows().alias("n"))
    rows = F.sum(F.when(F.col("__line").isNull(), F.col("n")).otherwise(1))
    return per_line.groupBy("path", "type").agg(
        rows.alias("n"), F.count_distinct(month).alias("months"), F.min(month).alias("first"), F.max(month).alias("last")
    )


def type_conflicts(found: DataFrame) -> DataFrame:
    """Paths seen with more than one type, nulls aside; the table has one row per path and type."""
    typed = found.where(F.col("type") != "VOID")
    return typed.withColumn("types", F.count(F.lit(1)).over(Window.partitionBy("path"))).where(F.col("types") > 1)


def forbidden_paths(found: DataFrame, names: list[str]) -> DataFrame:
    last = F.element_at(F.split(F.regexp_replace("path", r"\[\]", ""), r"\."), -1)
    return found.where(last.isin(names))
