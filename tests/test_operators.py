"""Operators on small fixtures with expectations computed another way."""

import datetime
import hashlib
import hmac
import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions import tokens as TK
from trackmetrics.operators import features as FT
from trackmetrics.operators import incremental as I
from trackmetrics.operators import models as M
from trackmetrics.operators import profiling as P
from trackmetrics.operators import quality as Q
from trackmetrics.operators import resolve as R
from trackmetrics.operators import stats as S
from trackmetrics.operators import tags as G
from trackmetrics.operators import warehouse as W
from trackmetrics.sources import layout as L
from trackmetrics.sources import readers as RD


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


# -- columns -----------------------------------------------------------------------


def test_hmac_token_equals_the_library(spark):
    key = bytes((i * 7 + 3) % 256 for i in range(64))
    users = ["1", "été", "", "a" * 200]
    wanted = [hmac.new(key, u.encode(), hashlib.sha256).hexdigest()[:32] for u in users]
    assert column(spark, users, "string", lambda c: TK.hmac_token(c, key)) == wanted


def test_salted_token_widths(spark):
    salt = "s" * 32
    full = hashlib.sha256((salt + "42").encode()).hexdigest()
    for bits in (64, 128, 256):
        assert column(spark, [42], "int", lambda c: TK.salted_token(c, salt, bits)) == [full[: bits // 4]]


@pytest.mark.parametrize("bad", [("short", 128), ("s" * 32, 60), ("s" * 32, 130), ("s" * 32, 260)])
def test_weak_salts_are_refused(spark, bad):
    with pytest.raises(ValueError):
        TK.salted_token(F.lit("1"), *bad)


def test_ascii_key(spark):
    values = ["Song! One_1", "Café", "!!!", None, "A b\tC"]
    assert column(spark, values, "string", X.ascii_key) == ["songone_1", None, None, None, "abc"]


def test_spotify_formats(spark):
    sid = "0" * 21 + "Z"
    values = [None, f"https://open.spotify.com/track/{sid}?si=1", f"spotify:track:{sid}", sid, f"https://open.spotify.com/album/{sid}", "x"]
    assert column(spark, values, "string", X.spotify_format) == ["absent", "url_track", "uri_track", "nu_22", "autre", "autre"]
    assert column(spark, values, "string", X.spotify_track) == [None, sid, sid, sid, None, None]


def test_decades_and_labels(spark):
    assert column(spark, [None, 0, 1999, 2000], "int", X.decade) == ["inconnue", "inconnue", "1990s", "2000s"]
    assert column(spark, [None, " NaN", "rock", "null", ""], "string", X.genre_label) == ["(absent)", "(absent)", "rock", "(absent)", "(absent)"]


def test_copy_escapes(spark):
    values = ["a\\tb", "a\\\\tb", "x\\\\", "\\n"]
    assert column(spark, values, "string", X.decode_copy) == ["a\tb", "a\\tb", "x\\", "\n"]


def test_tag_normaliser(spark):
    forms = {
        "Lo-Fi": "lo fi", "Salt & Pepper": "salt and pepper", "trip/hop_jazz": "trip hop jazz", "ﬂute": "flute", "ＤＵＢ": "dub", " \u00a0 ": None,
        "A\u030angstro\u0308m": "ångström", "tab\\there": "tab here", "--": None, "dnb": "drum and bass", "ＤＮＢ": "drum and bass",
    }
    synonyms = spark.createDataFrame([("dnb", "drum and bass")], "from_tag string, to_tag string")
    got = X.normalise_names(spark.createDataFrame([(n,) for n in forms], "nom string"), "nom", synonyms)
    assert {r["nom"]: r["tag"] for r in got.collect()} == forms


# -- resolution ----------------------------------------------------------------------


def test_catalogue_matching(spark):
    """Each listen carries in its msid the route and track that are expected for it."""
    code = lambda c: c * 22
    titles = spark.createDataFrame(
        [("t-id", "Harbour", "Nils", code("q")), ("t-key", "Lantern", "Oda", None), ("t-rec", "Meadow", "Pia", None), ("t-twin1", "Fog", "Quirin", code("z")),
         ("t-twin2", "Fog", "Quirin", code("z")), ("t-accent", "Être", "Rémy", None)],
        "track_id string, name string, artist string, spotify_id string")
    canon = spark.createDataFrame([("r-meadow", "Pia", "Meadow", "piameadow"), ("r-else", "Uwe", "Else", "uweelse")],
                                  "rec_id string, artist_name string, rec_name string, lookup_key string")
    known = spark.createDataFrame([("t-rec/musicbrainz", "r-meadow"), ("none/1", "r-else")], "msid string, rec_id string")
    listens = spark.createDataFrame(
        [("t-id/spotify", "x", "y", f"spotify:track:{code('q')}", None), ("t-id/spotify 2", "Oda", "Lantern", None, f"https://open.spotify.com/track/{code('q')}?a=b"),
         ("t-key/cle_artiste_titre", "ODA", "Lantern!", None, None), ("t-rec/musicbrainz", "someone", "(live)", None, None),
         ("none/1", "Uwe", "Else", None, None), ("none/2", "Quirin", "Fog", code("z"), None), ("none/3", "Rémy", "Être", None, None)],
        "msid string, artist_name string, track_name string, spotify_id string, spotify_uri string")
    found = R.match_catalog(listens.unionAll(listens), titles, known, canon).collect()
    assert len(found) == 7 and all(r["listens"] == 2 for r in found)
    for r in found:
        track, route = r["msid"].split(" ")[0].split("/")
        assert (r["track_id"] or "none") == track and (route.isdigit() or r["route"] == route)


def test_latest_version_puts_nulls_last(spark):
    rows = [("a", None, "old"), ("a", datetime.date(2024, 1, 1), "new"), ("a", datetime.date(2023, 1, 1), "mid"), ("b", datetime.date(2024, 1, 1), None), ("b", datetime.date(2024, 1, 1), "full")]
    df = spark.createDataFrame(rows, "k string, v date, x string")
    assert {r["k"]: r["x"] for r in R.latest_version(df, "k", "v").collect()} == {"a": "new", "b": "full"}


def test_key_step_is_dropped_when_the_hypothesis_fails(spark):
    canon = spark.createDataFrame([("r1", "A", "B", "other"), ("r2", "C", "D", "cd")], "rec_id string, artist_name string, rec_name string, lookup_key string")
    redirect = spark.createDataFrame([("r9", "r1")], "rec_id string, canon_id string")
    combos = spark.createDataFrame([("m", None, None, "cd", 3)], "msid string, mbid string, lastfm string, match_key string, listens long")
    assert R.resolve(combos, canon, redirect).first()["method"] == "aucune"


# -- incremental -----------------------------------------------------------------------


LEDGER = [(10, 100, 200), (14, 200, 300)]
# (number, start, end) of a candidate -> its verdict against LEDGER
VERDICTS = {
    (10, 0, 0): "RECHARGEMENT", (14, 200, 300): "RECHARGEMENT",
    (8, 0, 100): "PREMIER", (8, 0, 99): "TROU", (8, 0, 101): "CHEVAUCHEMENT",
    (12, 200, 200): "SUITE", (12, 200, 199): "TROU", (12, 200, 201): "CHEVAUCHEMENT", (12, 201, 200): "TROU", (12, 199, 200): "CHEVAUCHEMENT",
    (16, 300, 400): "SUITE", (16, 301, 400): "TROU", (16, 299, 400): "CHEVAUCHEMENT",
}


def test_continuity_of_candidates(spark):
    schema = "no int, start_s int, end_s int"
    for case, verdict in VERDICTS.items():
        assert I.candidate_continuity(spark.createDataFrame([case], schema), spark.createDataFrame(LEDGER, schema)).first()["verdict"] == verdict, case


def test_an_empty_ledger_is_an_error(spark):
    published = spark.createDataFrame([(1,)], "no int")
    with pytest.raises(Exception, match="empty ledger"):
        I.pending(published, published.where("no > 5")).collect()


def test_early_and_late_events(spark):
    df = spark.createDataFrame([("2024-02-01", d) for d in ("2024-02-03", "2024-02-01", "2024-01-02", "2024-01-01")], "r string, d string")
    df = df.select(F.col("r").cast("date").alias("r"), F.col("d").cast("date").alias("d"))
    assert [r["jour"] for r in I.route_late(df, "r", "d").orderBy(F.desc("d")).collect()] == ["2024-02-03", "2024-02-01", "2024-01-02", "_ancien"]
    wrong = I.route_late(df, "r", "d").withColumn("jour", F.lit("2024-02-01"))
    assert I.routing_errors(wrong, "r", "d").first()["wrong_day"] == 3


def test_volume_anomalies_zero_median_is_infinite(spark):
    series = [(f"l{i:02d}", 0) for i in range(6)] + [("l06", 5), ("l07", 0)]
    got = I.volume_anomalies(spark.createDataFrame(series, "lot string, n long"), "lot", "n", 12, 5.0, 0.5, 6)
    assert [(r["lot"], r["ratio"]) for r in got.orderBy("lot").collect()] == [("l06", float("inf")), ("l07", float("inf"))]


def test_fingerprint_sees_a_shifted_null(spark):
    one, two = (I.fingerprint(spark.createDataFrame([r], "a string, b string, c string"), ["a", "b", "c"]).first() for r in (("a", None, "b"), ("a", "b", None)))
    assert one["digest"] != two["digest"]


def test_fingerprint_sees_a_double_load(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    one, two = (I.fingerprint(x, ["i", "s"]).first() for x in (df, df.unionByName(df.where("i = 1"))))
    assert one["n"] != two["n"] and one["digest"] != two["digest"]
    assert I.fingerprint(df.orderBy(F.desc("i")), ["i", "s"]).first() == one


def test_merge_never_deletes_and_is_neutral_when_repeated(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 5), ("c", 3)], "k string, v int")
    changes = I.differing_groups(old, new, ["k"], ["v"])
    assert {(r["k"], r["kind"]) for r in changes.collect()} == {("b", "modifie"), ("c", "nouveau")}
    merged = I.merge_groups(old, changes.drop("kind"), ["k"], ["v"])
    assert {(r["k"], r["v"]) for r in merged.collect()} == {("a", 1), ("b", 5), ("c", 3)}
    assert I.differing_groups(merged, new, ["k"], ["v"]).count() == 0


# -- statistics, quality ------------------------------------------------------------------


def test_kappa_by_hand(spark):
    df = spark.createDataFrame([(1, 1)] * 2 + [(1, 0)] * 1 + [(0, 1)] * 1 + [(0, 0)] * 4, "a int, b int")
    row = S.contingency(df, F.col("a") == 1, F.col("b") == 1).first()
    po, pe = 6 / 8, (3 * 3 + 5 * 5) / 64
    assert row["kappa"] == round((po - pe) / (1 - pe), 4) and row["observed"] == 0.75
    same = spark.createDataFrame([(1, 1)] * 3, "a int, b int")
    assert S.contingency(same, F.col("a") == 1, F.col("b") == 1).first()["kappa"] == 0.0


def test_concentration_counts_at_least_one_row(spark):
    df = spark.createDataFrame([(v,) for v in (1, 1, 2, 6)], "v int")
    assert S.concentration(df, "v").first()["top1_pct"] == 60.0
    many = spark.createDataFrame([(v,) for v in [1] * 198 + [10, 90]], "v int")
    assert S.concentration(many, "v").first()["top1_pct"] == round(100 * 100 / 298, 2)


def test_every_catalog_check_can_fail(spark):
    columns = ", ".join(f"{c} double" for c in FT.AUDIO)
    good = (1.0,) * 2 + (0.0, 0.0, 1.0) + (0.5,) * 5 + (100.0, 4.0, 1000.0)
    bad = (2.0,) + (None,) * 12
    schema = f"track_id string, genre string, year int, {columns}"
    clean = spark.createDataFrame([("a", "g", 2000, *good), ("b", "g", 2001, *good)], schema)
    dirty = spark.createDataFrame([("a", None, None, *bad), ("a", None, None, *bad)], schema)
    status = lambda df, n: {r["check"]: r["ok"] for r in Q.run(df, list(Q.catalog_checks(n).values())).collect()}
    assert set(status(clean, 2).values()) == {1}
    assert status(dirty, 3) == {"dq1": 0, "dq2": 0, "dq3": 0, "dq4": 0, "dq5": 0, "dq6": 1}
    assert Q.verdict(Q.run(dirty, list(Q.catalog_checks(3).values()))).first()["status"] == "ECHEC"


def test_publication_null_is_under_k(spark):
    df = spark.createDataFrame([(None,), (9,)], "n int")
    assert Q.publication(df, "n", 5).first()["ok"] == 0
    assert Q.publication(df.where("n = 9"), "n", 5).first()["ok"] == 1
    assert Q.publication(df.where("n > 50"), "n", 5).first()["ok"] == 0  # an empty table proves nothing


def test_vocabulary_rows_keep_every_spelling(spark):
    tags = spark.createDataFrame([(1, "Hip-Hop", 2), (2, "hip hop", 1), (2, "rock", 1), (3, "HIP_HOP", 0)], "item int, nom string, votes int")
    names = G.raw_names(tags)
    assert {(r["nom"], r["tag"], r["raw_names"]) for r in names.collect()} == {
        ("Hip-Hop", "hip hop", 3), ("hip hop", "hip hop", 3), ("HIP_HOP", "hip hop", 3), ("rock", "rock", 1)}
    per_item = G.item_tags(tags, "item")
    assert {(r["item"], r["tag"], r["votes"]) for r in per_item.collect()} == {(1, "hip hop", 2), (2, "hip hop", 1), (2, "rock", 1)}
    vocab = G.tag_statistics(per_item).where("items >= 2")
    assert {r["tag"] for r in G.kept_items(per_item, vocab).collect()} == {"hip hop"}


# -- models -----------------------------------------------------------------------------


def test_auc_and_precision_at_recall_by_brute_force(spark):
    data = [(0.9, 1), (0.8, 0), (0.8, 1), (0.7, 1), (0.4, 0), (0.4, 1), (0.1, 0)]
    df = spark.createDataFrame(data, "score double, y int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    wanted = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.auc(df, "y").first()["auc"] == pytest.approx(wanted, abs=1e-6)
    cuts = sorted({s for s, _ in data}, reverse=True)
    above = [(sum(s >= c for s in pos), sum(s >= c for s, _ in data)) for c in cuts]
    area = sum((hit - old) / len(pos) * hit / n for (hit, n), (old, _) in zip(above, [(0, 0), *above]))
    assert M.average_precision(df, "y").first()["auc_pr"] == pytest.approx(area, abs=1e-6)
    best = M.precision_at_recall(df, "y").first()
    assert (best["threshold"], best["precision"], best["recall"]) == (0.7, 0.75, 0.75)


def test_folds_hold_whole_groups_and_stay_balanced(spark):
    sizes = {"big": 300, "mid": 150, **{f"g{i}": 5 for i in range(60)}}
    df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)] + [(None,)] * 4, "g string")
    dealt = M.group_folds(df, "g", folds=3)
    assert dealt.count() == df.count()
    assert dealt.groupBy("g").agg(F.count_distinct("fold").alias("f")).where("f <> 1").count() == 0
    assert dealt.where("g IN ('big', 'mid')").select("fold").distinct().count() == 2


def test_donor_rows_are_a_permutation(spark):
    df = spark.range(50).selectExpr("id", "id * 2 AS v")
    paired = M.with_donor(df, ["v"], "id").select("id", "v", F.col("donor.v").alias("d")).collect()
    assert sorted(r["d"] for r in paired) == sorted(r["v"] for r in paired) and all(r["d"] != r["v"] for r in paired)


def test_leave_one_out_of_a_single_title_is_null(spark):
    df = spark.createDataFrame([(1, "a", 10, 1), (2, "a", 20, 0), (3, "b", 5, 0), (4, None, 7, 1), (5, None, 9, 0)],
                               "track_id int, artist string, total_plays long, is_hit int")
    got = {r["track_id"]: (r["artist_other_titles"], r["artist_other_mean_plays"], r["artist_other_hit_rate"]) for r in FT.leave_one_out(df).collect()}
    assert got == {1: (1, 20.0, 0.0), 2: (1, 10.0, 1.0), 3: (0, None, None), 4: (1, 9.0, 0.0), 5: (1, 7.0, 1.0)}


# -- layout and readers --------------------------------------------------------------------


def test_slices_equal_greedy_packing(spark):
    lots = [(f"2010-{m:02d}", n) for m, n in enumerate((5, 5, 20, 3, 3, 3, 12), 1)]
    wanted, current = [], []
    for lot in lots:
        if current and sum(n for _, n in current) + lot[1] > 10:
            wanted.append(current)
            current = []
        current.append(lot)
    wanted.append(current)
    got = L.slices(spark.createDataFrame(lots, "lot string, n int"), "lot", "n", 10).orderBy("no").collect()
    assert [(r["first"], r["last"], r["n"], r["lots"]) for r in got] == [(w[0][0], w[-1][0], sum(n for _, n in w), len(w)) for w in wanted]


def test_planned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "CAST(id % 2 AS STRING) AS p")
    assert L.write_planned(df, path, ["p"], ["id"], row_bytes=100.0, target_bytes=20_000) == 6
    assert {(r["part"], r["files"], r["n_rows"]) for r in L.file_report(spark.read.parquet(path), r"p=([^/]+)").collect()} == {("0", 3, 500), ("1", 3, 500)}
    L.write_planned(df.where("p = '1' AND id < 10"), path, ["p"], ["id"], row_bytes=100.0)
    assert spark.read.parquet(path).groupBy("p").count().where("p = 0").first()["count"] == 500
    assert spark.read.parquet(path).where("p = 1").count() == 5


def test_small_planned_files_are_written_many_by_a_task(spark, tmp_path, monkeypatch):
    """Tasks follow the bytes: several files each, and no partition beyond its plan, however its rows fall into buckets."""
    df = spark.range(3000).selectExpr("id", "id % 7 AS s", "CASE WHEN id < 2500 THEN 'a' WHEN id < 2999 THEN 'b' ELSE 'c' END AS p")
    for task_bytes, n_tasks in ((L.TASK_BYTES, 3), (8_000, 15)):
        monkeypatch.setattr(L, "TASK_BYTES", task_bytes)
        path = str(tmp_path / str(task_bytes))
        assert L.write_planned(df, path, ["p"], ["id"], row_bytes=10.0, target_bytes=500) == 61
        found = spark.read.parquet(path).selectExpr("*", "_metadata.file_name AS f").cache()
        files = {r["p"]: r["count"] for r in found.select("p", "f").distinct().groupBy("p").count().collect()}
        assert 45 <= files["a"] <= 50 and 8 <= files["b"] <= 10 and files["c"] == 1
        assert 0 < found.selectExpr("substring(f, 1, 10)").distinct().count() <= n_tasks
        assert sorted(r["id"] for r in found.collect()) == list(range(3000))


def test_path_audit(spark):
    paths = ["a/date=2024-01-31/f", "a/date=2024-02-31/f", "a/date=2024-1-31/f", "b/mois=2024-13/f", "b/mois=2024-12/f", "x"]
    got = L.path_audit(spark.createDataFrame([(p,) for p in paths], "path string"), "path",
                       {"day": r"^a/date=(\d{4}-\d{2}-\d{2})/[^/]+$", "month": r"^b/mois=(\d{4}-\d{2})/[^/]+$"})
    assert [r["class"] for r in got.collect()] == ["day", "REFUSE", "REFUSE", "REFUSE", "month", "REFUSE"]


def test_csv_by_name_refuses_missing_columns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,x\nz,y\n")
    df = RD.csv_by_name(spark, str(tmp_path / "x.csv"), {"a": "string", "b": "int"})
    assert [(r["a"], r["b"]) for r in df.collect()] == [("x", 1), ("y", None)]
    with pytest.raises(ValueError, match="missing"):
        RD.csv_by_name(spark, str(tmp_path / "x.csv"), {"c": "int"})


def test_strict_csv_stops_on_a_bad_record(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\nx,y\n')
    df = RD.csv_strict(spark, str(tmp_path / "x.csv"), spark.createDataFrame([], "a int, b string").schema)
    with pytest.raises(Exception):
        df.collect()


# -- plans ------------------------------------------------------------------------------


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_partkey < 50").groupBy("l_partkey").count()
    text = plan(df)
    assert "PushedFilters: [IsNotNull(l_partkey), LessThan(l_partkey,50)]" in text
    assert "ReadSchema: struct<l_partkey:bigint>" in text


def test_month_predicate_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.sql("SELECT DATE '2024-01-05' AS date, '2024-01' AS mois UNION ALL SELECT DATE '2024-02-05', '2024-02'").write.partitionBy("mois").parquet(path)
    df = W.date_range(L.read_partitioned(spark, path), "2024-01-01", "2024-02-01")
    assert "PartitionFilters: [isnotnull(mois" in plan(df) and df.count() == 1


def test_no_operator_needs_a_cartesian_product(spark):
    df = spark.createDataFrame([(1, "a", 10, 1)], "track_id int, artist string, total_plays long, is_hit int")
    for found in (FT.leave_one_out(df), S.concentration(df, "total_plays"), S.shares(df, "artist", "total_plays", "is_hit")):
        assert "CartesianProduct" not in plan(found) and "BroadcastNestedLoopJoin" not in plan(found)


def test_replication_keeps_copy_zero(spark):
    df = spark.createDataFrame([("u", 1)], "user_id string, p int")
    got = {r["user_id"] for r in W.replicate(df, "user_id", 3).collect()}
    assert got == {"u", hashlib.sha1(b"u#1").hexdigest(), hashlib.sha1(b"u#2").hexdigest()}


def test_profile_runs_in_one_aggregate(spark):
    df = spark.range(10).selectExpr("id AS a", "id AS b")
    assert plan(P.null_rates(df)).count("Exchange") <= 2


def test_forest_queries_use_the_published_size(spark, monkeypatch):
    from types import SimpleNamespace

    from trackmetrics.operators import models
    from trackmetrics.plans import modelling

    made = []
    monkeypatch.setattr(modelling, "matrix", lambda *a, **k: None)
    monkeypatch.setattr(modelling, "columns_of", lambda df, wanted: ["age"])
    monkeypatch.setattr(modelling, "results", lambda t, rows: rows)
    monkeypatch.setattr(models, "group_holdout", lambda df, group: None)
    monkeypatch.setattr(models, "cross_validate", lambda df, target, make, name: made.append(make()))
    monkeypatch.setattr(models, "holdout_auc", lambda df, target, make, side: made.append(make()))
    modelling.random_forest(SimpleNamespace(spark=spark))
    modelling.ablation(SimpleNamespace(spark=spark))
    sizes = {(m.getNumTrees(), m.getMaxDepth(), m.getMinInstancesPerNode()) for m in (p.getStages()[-1] for p in made)}
    assert len(made) == 8 and sizes == {(300, 30, 5)}
