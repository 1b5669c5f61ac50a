"""Queries do their whole job: every line counts, and plans stay within bounds."""

import datetime

from trackmetrics.plans import load
from trackmetrics.plans.registry import BODIES
from trackmetrics.sources.views import Tables

load()
_FLAGS = ("truncated", "no_track", "has_ip", "has_new", "drift", "discarded")


def tables(spark, **kept):
    t = Tables(spark, "/nowhere")
    t._kept.update(kept)
    return t


def raw_listens(spark, *flags):
    """One listen per entry; an entry names the flags that hold."""
    rows = [
        (i, 1_707_868_800 + i, datetime.date(2024, 2, 14), "2024-02", 1, f"{i:032x}", f"m{i}", f"r{i}", "A", f"T{i}", False, *[f in held for f in _FLAGS])
        for i, held in enumerate(flags)
    ]
    return spark.createDataFrame(rows, (
        "event_id long, ts_s long, date date, mois string, k int, user_tok string, msid string, mbid string, artist_name string, track_name string, "
        "private_flag boolean, " + ", ".join(f"{f} boolean" for f in _FLAGS)
    ))


def test_volume_audit_counts_cut_lines(spark):
    row = BODIES["ag7_raw_volume_audit"](tables(spark, raw_listens=raw_listens(spark, (), ("truncated",)))).first()
    assert (row["n"], row["listeners"], row["with_mbid"], row["rejects"]) == (2, 2, 2, 1)
    assert row["ts_max"] - row["ts_min"] == 1


def test_audit_reads_whole_fields_of_cut_lines(spark):
    from trackmetrics.operators.contract import raw_audit

    info = ',"track_metadata":{"artist_name":"a \\"b\\" {","additional_info":{"duration_ms":3,"recording_mbid":"r1","tr'
    cut = ['{"user_id":"u1","timestamp":7' + info, '{"user_id":"u2","timestamp":50' + info.replace("mbid", "other"), '{"user_id":"u2","timestamp":9', '{"user_id":"u', '{"timestamp":8,"x":{"user_id":"u3"']
    lines = spark.createDataFrame([(v, datetime.date(2024, 2, 14)) for v in cut], "value string, date date")
    found = raw_audit(lines, "date", cut_lines=True).first()
    assert found.asDict() == {"n": 5, "listeners": 2, "with_mbid": 1, "ts_min": 7, "ts_max": 50, "rejects": 5, "forbidden": 0, "bad_tokens": 0, "outside_day": 0}
    assert raw_audit(lines, "date").first()["listeners"] == 0


def test_load_takes_lines_with_forbidden_and_new_keys(spark):
    lines = raw_listens(spark, (), ("has_ip",), ("has_new",), ("has_ip", "truncated"), ("no_track",))
    assert [r["n"] for r in BODIES["st1_incremental_load"](tables(spark, raw_listens=lines)).collect()] == [3]


def test_sketches_are_not_carried_by_every_distinct_value(spark):
    listens = spark.createDataFrame([("u1", "A", "x"), ("u2", "a", "X"), ("u2", "B", "x")], "user_tok string, artist_name string, track_name string")
    found = BODIES["ag6_approx_distinct"](tables(spark, listens_flat=listens))
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.first()[:] == (2, 2, 2, 2, True)


def test_shuffles_grow_with_the_input_and_tasks_do_not(spark, tmp_path):
    from trackmetrics.session import ADVISORY_CONF, INPUT_BYTES, TASK_BYTES, shuffle_width

    before = spark.conf.get(ADVISORY_CONF)
    try:
        (tmp_path / "lineitem.parquet").write_bytes(b"0" * (20 * INPUT_BYTES + 1))
        Tables(spark, str(tmp_path))
        assert shuffle_width(spark) == 21 and spark.conf.get(ADVISORY_CONF) == str(TASK_BYTES)
        spark.conf.set(ADVISORY_CONF, "1m")
        Tables(spark, "/nowhere")
        assert shuffle_width(spark) == 8 and spark.conf.get(ADVISORY_CONF) == "1m"
    finally:
        spark.conf.set(ADVISORY_CONF, before)


def test_item_tags_shuffle_votes_once(spark):
    from trackmetrics.operators import tags as G

    rows = [(1, "Pop & Rock", 2), (1, "pop and  rock", 1), (1, "ﬁlm", 1), (2, "Été-pop", 3), (2, "ÉTÉ\\tpop", 1), (2, "  ", 4), (2, None, 5), (None, "x", 1), (3, "x", 0)]
    found = G.item_tags(spark.createDataFrame(rows, "item int, nom string, votes int"), "item")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {tuple(r) for r in found.collect()} == {(1, "pop and rock", 3), (1, "film", 1), (2, "été pop", 4), (None, "x", 1)}


def test_item_tags_follow_synonyms(spark):
    from trackmetrics.operators import tags as G

    tags = spark.createDataFrame([(1, "hiphop", 2), (1, "Hip-Hop", 1), (2, "rap", 1)], "item int, nom string, votes int")
    pairs = spark.createDataFrame([("hiphop", "hip hop")], "from_tag string, to_tag string")
    assert {tuple(r) for r in G.item_tags(tags, "item", synonyms=pairs).collect()} == {(1, "hip hop", 3), (2, "rap", 1)}


def test_altered_batches_write_the_lines_once(spark, monkeypatch):
    from trackmetrics.operators import contract as CT

    parsed, parse = [], CT.parse
    monkeypatch.setattr(CT, "parse", lambda lines, contract: parsed.append(lines.count()) or parse(lines, contract))
    found = BODIES["ct14_altered_batches"](tables(spark, raw_listens=raw_listens(spark, *[()] * 18, ("drift",), ("no_track",)))).collect()
    assert sum(parsed) == 18 + 5 * 2
    assert {tuple(r) for r in found} == {("temoin", 0, 0, 1, 1), ("champ_nouveau", 2, 0, 1, 1), ("type_modifie", 0, 0, 3, 1), ("champ_disparu", 0, 0, 1, 3), ("champ_purge", 0, 2, 1, 1)}


def test_copies_of_the_history_are_not_shuffled(spark):
    history = spark.createDataFrame([(1, 7, 3), (2, 7, 9), (2, 8, 1), (None, 8, 2)], "user_id int, track_id int, playcount int")
    found = BODIES["qm_top_tracks_x10"](tables(spark, history=history))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Exchange") and plan[: plan.index("Generate")].count("Exchange hashpartitioning(track_id") == 1
    assert {tuple(r) for r in found.collect()} == {(7, 120, 20), (8, 30, 19)}  # a null user is no listener, its copies are


def test_models_run_side_by_side_in_order():
    from threading import Barrier

    from trackmetrics.operators import models as M

    together = Barrier(2, timeout=20)  # broken if one job waits for the other
    assert M.side_by_side(lambda i: together.wait() * 0 + i, [1, 2]) == [1, 2]


def test_models_score_in_a_session_that_observed_a_query(spark):
    from pyspark.sql import Observation, functions as F

    from trackmetrics.operators import models as M

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    df = spark.createDataFrame([(float(i % 7), i % 7 // 4, i % 2) for i in range(60)], "a double, is_hit int, fold int")
    for make in (lambda: M.forest(["a"], "is_hit", 2, 3), lambda: M.logistic(["a"], "is_hit")):
        assert [r[1:4] for r in M.cross_validate(df, "is_hit", make, "observed")] == [(0, 30, 1.0), (1, 30, 1.0)]


def test_facts_are_computed_once_for_the_merge_proof(spark):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(value):
        seen.add(1)
        return value

    rows = [(datetime.date(2001, month, 1), f"2001-{month:02d}", f"m{k}", k, 1) for month in (6, 7, 8) for k in range(4)]
    facts = spark.createDataFrame(rows, "date date, mois string, msid string, listens long, listeners long").withColumn("listens", counted("listens"))
    found = {r["state"]: r[1:] for r in BODIES["st14_merge_proof"](tables(spark, day_facts=facts)).collect()}
    assert found == {"initial": (12, 1, None), "damaged": (8, 0, 8), "merged": (12, 1, 0), "merged_again": (12, 1, 0)}
    assert seen.value == len(rows)


def test_lines_loaded_more_than_once_are_parsed_once(spark, monkeypatch):
    from trackmetrics.operators import contract

    parsed, parse = [], contract.parse
    monkeypatch.setattr(contract, "parse", lambda lines, c: parsed.append(lines) or parse(lines, c))
    lines = raw_listens(spark, *[()] * 300, ("truncated",), ("drift",), ("has_ip",))
    t = tables(spark, raw_listens=lines, listens=lines)
    found = [(r["dump"], r["outcome"], r["n_read"], r["kept"], r["rejected"], r["written"], r["stored"]) for r in BODIES["ct9_all_or_nothing"](t).collect()]
    assert found == [
        ("1", "REFUSE", 303, 301, 2, 0, 0), ("2", "REFUSE", 302, 300, 2, 0, 0), ("3", "REFUSE", 302, 300, 2, 0, 0),
        ("4", "CONTROLE_OK", 302, 300, 2, 0, 0), ("5", "APLATI_OK", 302, 300, 2, 300, 300), ("5", "APLATI_ECHEC", 604, 600, 4, 300, 300),
    ]
    assert len(parsed) == 2
