"""Counting helper shared by the operators."""

from pyspark.sql import Column, DataFrame, functions as F


def n_rows() -> Column:
    return F.count(F.lit(1))


def n_distinct(df: DataFrame, column: str) -> Column:
    """Distinct non-null values as a scalar subquery in two levels, which never multiplies the rows as several distinct counts in one aggregate do."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().agg(n_rows()).scalar()
