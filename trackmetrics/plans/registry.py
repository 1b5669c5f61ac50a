"""Name -> query and name -> oracle SQL, filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackmetrics.sources.views import Tables, duckdb_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BODIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of :class:`Tables`; ``oracle`` is SQL over the same views."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        BODIES[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = duckdb_query(oracle)
        return fn

    return register
