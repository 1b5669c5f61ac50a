"""Every registered query against its oracle on the smallest tables; queries without oracle must return rows."""

import pytest

import __spark_entry__ as entry
from tests.parity import DATA, compare, connect

FOLDER = str(DATA / "sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# tests/llm covers the training-data operators.
RUN = [n for n in QUERIES if n != "pipeline" and not n.startswith("op")]
WITHOUT_ORACLE = [n for n in RUN if n not in ORACLES]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in RUN if n in ORACLES])
def test_matches_oracle(spark, con, name):
    problem = compare(QUERIES[name](spark, FOLDER), ORACLES[name], con)
    assert problem in ("", "EMPTY on both sides"), problem


@pytest.mark.parametrize("name", WITHOUT_ORACLE)
def test_returns_rows(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    for row in rows:  # columns that state a bound or a check must hold
        for flag in ("within_bound", "within_5_pct"):
            assert row.asDict().get(flag, True)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["track_id", "plays", "listeners"]
    assert df.count() == 10


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_bucketed_plans_have_no_exchange(spark):
    assert {r["key_exchanges"] for r in QUERIES["qe_plan_evidence"](spark, FOLDER).collect()} == {0}


def test_range_files_are_narrower_than_hash_files(spark):
    days = {r["layout"]: r["avg_days"] for r in QUERIES["tk7_storage_order_probe"](spark, FOLDER).collect()}
    assert days["range"] < days["hash"] / 2
