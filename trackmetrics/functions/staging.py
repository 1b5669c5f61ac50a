"""Optimizer staging."""

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A later filter on a plain projection is pushed below it with the expression
    copied in; behind a generator the value is computed once and only read.
    """
    return df.select(*df.columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
