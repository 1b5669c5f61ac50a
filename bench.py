"""Headline queries on the test tables; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.  The facts are
stored once before the timing, as a warehouse holds them.  Every query runs once to warm up
(class loading, code generation) and is then timed; results are consumed by the
``noop`` sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from trackmetrics.plans import load
from trackmetrics.plans.registry import BODIES
from trackmetrics.session import build_session
from trackmetrics.sources.views import Tables

HEADLINE = (
    "qa_top_tracks qb_top_genres qc_key_range qf_title_totals qg_year_weekday qh_one_month qi_recent_titles qk_artist_control "
    "ag4_track_engagement ag10_grain_rollup ag11_two_level_facts ag27_spearman wn1_leave_one_out wn2_majority_choice "
    "prj11_row_router ct11_flatten st5_rebuilt_facts st13_merge pv1_salted_token dq14_dq16_raw_keys"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    load()
    tables = Tables(spark, folder).keep("history", "plays", "catalog", "listens", "listens_flat", "day_facts", "raw_listens")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):  # warm-up, then the timed run
            start = time.perf_counter()
            BODIES[name](tables).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(folder).name,
    }))


if __name__ == "__main__":
    main()
