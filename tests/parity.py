"""Compare a Spark result with its oracle SQL in DuckDB, ignoring row order.

``python tests/parity.py [sf] [name-prefix ...]`` prints one line per query.
With ``PARITY_EXACT=1`` numbers must also agree in type and to the last digit.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from trackmetrics.sources.views import BASE_TABLES  # noqa: E402

DATA = Path("/root/testdata")
EXACT = os.environ.get("PARITY_EXACT") == "1"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    """One representation per value for both engines."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if EXACT:
        return f"{type(value).__name__}:{value!r}"
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(df, sql: str, con) -> str:
    """'' when equal, otherwise a short description of the difference."""
    found = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(found) != len(wanted):
        return f"rows {len(found)} != {len(wanted)}"
    left, right = rows(df.columns, found), rows(names, wanted)
    for a, b in zip(left, right):
        if a != b:
            return f"columns {sorted(names)}\n    spark  {a}\n    oracle {b}"
    return "" if found else "EMPTY on both sides"


def main() -> int:
    import __spark_entry__ as entry
    from trackmetrics.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("parity", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    folder = str(DATA / sf)
    con = connect(folder)
    oracles, failed = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        if EXACT and name not in oracles:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                problem = compare(df, oracles[name], con)
            else:
                n = len(df.collect())
                problem = "" if n else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("FAILED", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
