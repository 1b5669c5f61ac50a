"""Contract parsing on planted lines; each check must be able to fail."""

import json

import pytest
from pyspark.sql import functions as F

from trackmetrics.operators import contract as CT
from trackmetrics.operators import loading as LD
from trackmetrics.operators import privacy as PV
from trackmetrics.operators import structure as SV
from trackmetrics.sources import layout as LY

TOKEN = "0123456789abcdef0123456789abcdef"


def listen(i=0, **over):
    info = {"duration_ms": 1000 + i, "tracknumber": 3, **over.pop("info", {})}
    meta = {"artist_name": "A", "track_name": f"T{i}", "additional_info": info, **over.pop("meta", {})}
    line = {"user_id": TOKEN, "timestamp": 1704067200 + i, "recording_msid": f"m{i}", "track_metadata": meta, **over}
    return json.dumps(line)


def frame(spark, lines):
    return spark.createDataFrame([(l,) for l in lines], "value string").select(
        F.lit("2024-01-01").cast("date").alias("date"), F.lit("2024-01").alias("mois"), "value"
    )


def category(spark, line):
    row = CT.parse(frame(spark, [line]), CT.LISTENS).select("category", "reason", "unknown", "drift").first()
    return row["category"], row["reason"], row["unknown"]


CASES = [
    (listen(), ("aplati", None, [])),
    (listen(info={"incognito_mode": True}), ("incognito", None, [])),
    (listen(info={"incognito_mode": False}), ("aplati", None, [])),
    (listen()[:-9], ("rebut", "json_invalide", [])),
    ("[1, 2]", ("rebut", "json_invalide", [])),
    (listen(meta={"track_name": None}), ("rebut", "champ_disparu:tm.track_name", [])),
    (listen(meta={"track_name": 7}), ("rebut", "type_modifie:tm.track_name", [])),
    (listen(meta={"release_name": True}), ("rebut", "type_modifie:tm.release_name", [])),
    (listen(meta={"release_name": {"z": 1}}), ("rebut", "type_modifie:tm.release_name", [])),
    (listen(info={"duration_ms": "trois minutes"}), ("rebut", "type_modifie:ai.duration_ms", [])),
    (listen(info={"tracknumber": "3/12"}), ("aplati", None, [])),
    (listen(info={"tracknumber": True}), ("rebut", "type_modifie:ai.tracknumber", [])),
    (listen(info={"artist_mbids": "a"}), ("rebut", "type_modifie:ai.artist_mbids", [])),
    (listen(info={"artist_mbids": []}), ("aplati", None, [])),
    (listen(info={"artist_names": [1, 2]}), ("rebut", "type_modifie:ai.artist_names", [])),
    (listen(info={"tracknumber": 3.5}), ("rebut", "type_modifie:ai.tracknumber", [])),
    (listen(info={"tracknumber": 3}), ("aplati", None, [])),
    (listen(meta={"additional_info": 5}), ("rebut", "type_modifie:tm.additional_info", [])),
    (listen(meta={"mbid_mapping": {"artists": [{"artist_mbid": "x", "artist_credit_name": 5}]}}),
     ("rebut", "type_modifie:mm.artists[].artist_credit_name", [])),
    (listen(meta={"mbid_mapping": {"artists": [{"artist_mbid": "x"}]}}), ("aplati", None, [])),
    (listen(info={"ip_addr": "1.2.3.4"}), ("aplati", None, ["ai.ip_addr"])),
    (listen(user_name="bob"), ("aplati", None, ["racine.user_name"])),
]


@pytest.mark.parametrize("line,expected", CASES)
def test_category_of_one_line(spark, line, expected):
    assert category(spark, line) == expected


def test_two_drifted_fields_are_both_named(spark):
    line = listen(meta={"release_name": 1}, info={"duration_ms": "x"})
    assert category(spark, line)[1] == "type_modifie:ai.duration_ms,tm.release_name"


def test_flattened_table_has_the_37_columns(spark):
    flat = CT.flatten(CT.parse(frame(spark, [listen(info={"track_mbid": "t", "artist_mbid": "a"})]), CT.LISTENS))
    assert flat.columns == CT.flat_columns() and len(flat.columns) == 37
    row = flat.first()
    assert (row["mbid_enregistrement"], row["mbid_provenance"], row["mbids_artistes"]) == ("t", "track_mbid", ["a"])


@pytest.mark.parametrize("key,family", [
    ("ai.ip_addr", "interdite"), ("racine.user_name", "interdite"), ("ai.tags", "interdite"),
    ("ai.origin_url", "ecartee"), ("tm.media-player", "ecartee"), ("tm.origin_url", "nouvelle"), ("ai.zzz", "nouvelle"),
])
def test_key_policy(spark, key, family):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(CT.key_policy(CT.LISTENS, F.col("k"))).first()[0] == family


@pytest.mark.parametrize("drifted,fields,refused", [(0, 1, False), (1, 1, False), (3, 1, True), (1, 2, True)])
def test_drift_tolerance(spark, drifted, fields, refused):
    bad = listen(meta={"release_name": 5}, info={"duration_ms": "x"} if fields == 2 else {})
    lines = [bad] * drifted + [listen(i) for i in range(20_000 - drifted)]
    checks = CT.verdict(CT.measures(CT.parse(frame(spark, lines), CT.LISTENS)), CT.LISTENS)
    assert (checks.where("failed").count() > 0) == refused


def test_minimise_keeps_types_and_drops_keys(spark):
    line = listen(user_name="bob", info={"ip_addr": "x", "origin_url": "y", "tracknumber": 4},
                  meta={"mbid_mapping": {"artists": [{"artist_mbid": "a", "secret": 1}]}})
    df = frame(spark, [line])
    out = json.loads(CT.minimise(df, CT.LISTENS).first()["value"])
    assert out["track_metadata"]["additional_info"] == {"duration_ms": 1000, "tracknumber": 4}
    assert out["track_metadata"]["mbid_mapping"] == {"artists": [{"artist_mbid": "a"}]} and "user_name" not in out
    removed = {r["key"]: (r["family"], r["n"]) for r in CT.removed_keys(df, CT.LISTENS).collect()}
    assert removed == {
        "racine.user_name": ("interdite", 1), "ai.ip_addr": ("interdite", 1), "ai.origin_url": ("ecartee", 1),
        "mm.artists[].secret": ("nouvelle", 1),
    }


def load(spark, tmp_path, lines, expected, dump="7", reception="2024-01-02", **kw):
    target, rejected = str(tmp_path / "flat"), str(tmp_path / "rejects")
    report = LD.load_batch(frame(spark, lines), CT.LISTENS, dump, reception, target, rejected, expected, **kw)
    return report.first(), target


def test_load_writes_once_and_reload_replaces(spark, tmp_path):
    lines = [listen(i) for i in range(5)] + [listen(1), listen(meta={"track_name": "x"}, info={"incognito_mode": True})]
    for _ in range(2):
        report, target = load(spark, tmp_path, lines, 7)
    assert (report["outcome"], report["written"], report["duplicates"], report["private"]) == ("APLATI_OK", 5, 1, 1)
    assert spark.read.parquet(target).count() == 5


@pytest.mark.parametrize("lines,expected,outcome", [
    ([], 0, "DUMP_VIDE"), ([], 3, "REFUSE"), ([listen(info={"incognito_mode": True})], 1, "VIDE_NON_ATTENDU"),
    ([listen()], 2, "REFUSE"), ([listen(info={"zzz": 1})], 1, "REFUSE"), ([listen(info={"ip_addr": "1"})], 1, "REFUSE"),
    ([listen(meta={"track_name": None})], 1, "REFUSE"),
])
def test_refused_batches_write_nothing(spark, tmp_path, lines, expected, outcome):
    report, target = load(spark, tmp_path, lines, expected)
    assert report["outcome"] == outcome and not (tmp_path / "flat").exists()


def test_old_events_go_to_the_old_partition(spark, tmp_path):
    _, target = load(spark, tmp_path, [listen()], 1, reception="2024-02-15")
    assert (tmp_path / "flat" / "mois=2024-01" / "jour=_ancien" / "dump=7").exists()


def files_of(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_a_load_that_fails_its_check_leaves_the_old_batch_as_it_was(spark, tmp_path):
    lines = [listen(i) for i in range(4)] + ["{cut"]
    assert load(spark, tmp_path, lines, 5)[0]["outcome"] == "APLATI_OK"
    before = files_of(tmp_path)
    report, _ = load(spark, tmp_path, lines * 2, 10, max_duplicates=0.25)
    assert (report["outcome"], report["written"], report["duplicates"]) == ("APLATI_ECHEC", 4, 4)
    assert files_of(tmp_path) == before


@pytest.mark.parametrize("stop_at", ["first", "second", "delete"])
def test_a_stopped_publication_is_finished_by_the_next_load(spark, tmp_path, monkeypatch, stop_at):
    """The driver stops between the moves; readers skip the marker and the staging folder, and the next load ends the work."""
    target = str(tmp_path / "flat")

    def days(*numbers):
        rows = [(f"2024-01-{n:02d}", listen(n, timestamp=1704067200 + 86400 * (n - 1))) for n in numbers]
        lines = spark.createDataFrame(rows, "date string, value string").select(F.col("date").cast("date"), F.lit("2024-01").alias("mois"), "value")
        return LD.load_batch(lines, CT.LISTENS, "7", "2024-01-09", target, str(tmp_path / "rejects"), len(numbers))

    assert days(1, 2, 3).first()["outcome"] == "APLATI_OK"
    real, calls = LY._file_system, []

    def failing(session, path):
        place = path.rsplit("/flat/", 1)[-1]
        calls.append(place)
        moves = [c for c in calls if c.startswith("mois=")]
        if (stop_at == "first" and len(moves) == 1) or (stop_at == "second" and len(moves) == 2):
            raise KeyboardInterrupt
        return real(session, path)

    monkeypatch.setattr(LY, "_file_system", failing)
    if stop_at == "delete":
        monkeypatch.setattr(LY, "delete_folders", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        days(2, 3, 4)
    monkeypatch.undo()
    assert (tmp_path / "flat" / "_publication.json").exists()
    assert LY.resume_publication(spark, target) and not LY.resume_publication(spark, target)
    assert {str(r["date"]) for r in spark.read.parquet(target).collect()} == {"2024-01-02", "2024-01-03", "2024-01-04"}
    assert not [p for p in (tmp_path / "flat").iterdir() if p.name.startswith("_") and p.name != "_SUCCESS"]


def test_registration_needs_a_good_load(spark, tmp_path):
    bad = LD.load_batch(frame(spark, [listen()]), CT.LISTENS, "8", "2024-01-02", str(tmp_path / "f"), str(tmp_path / "r"), 2)
    with pytest.raises(ValueError):
        LD.register_batch(spark, str(tmp_path / "ledger"), 8, (0, 1), bad, str(tmp_path / "f"), 10, "SUITE")
    assert not (tmp_path / "ledger").exists()


def test_contract_document_round_trip(spark):
    text = json.dumps({
        "version": 3, "interdites_toujours": ["user_name"],
        "niveaux": {"racine": {"chemin": "", "gardes": {"a": {"type": "texte", "obligatoire": True}}, "ecartes": ["b"], "purges": ["c"]}},
    })
    contract = CT.read_contract(text)
    assert contract.version == 3 and contract.levels["racine"].kept["a"].required
    assert CT.schema(contract).simpleString() == "struct<a:string>"


@pytest.mark.parametrize("body", [{"ip_addr": "a,b"}, {"ip_addr": 5, "x": 1}, {"x": 1, "ip_addr": True}, {"x": "q", "ip_addr": 'z"y', "w": 2}])
def test_purge_leaves_valid_json(spark, body):
    line = listen(info=body)
    out = PV.purge_keys(frame(spark, [line]), ["ip_addr"]).first()
    wanted = json.loads(line)
    wanted["track_metadata"]["additional_info"].pop("ip_addr")
    assert json.loads(out["value"]) == wanted and out["purged"] == 1


@pytest.mark.parametrize("body", ['{"a":1,"ip_addr":"198.51.', '{"ip_addr":"19', '{"a":1,"ip_addr":"x\\', '{"a":1,"ip_addr":', '{"a":1,"ip_addr":tru', '{"a":1,"ip_addr":12'])
def test_purge_of_a_member_cut_by_the_end_of_its_line(spark, body):
    out = PV.purge_keys(frame(spark, [body]), ["ip_addr"]).first()
    assert out["purged"] == 1 and out["value"] == ('{"a":1' if '"a"' in body else "{")


def test_purge_of_an_object_value_raises(spark):
    with pytest.raises(Exception, match="sensitive key"):
        PV.purge_keys(frame(spark, [listen(info={"ip_addr": {"v": 1}})]), ["ip_addr"]).collect()


def test_structure_survey_counts_a_list_path_once_per_line(spark):
    lines = spark.createDataFrame([(1, "2024-01", '{"a":[{"b":1},{"b":2}],"c":null}'), (2, "2024-02", '{"a":[{"b":"x"}]}')], "id int, mois string, value string")
    found = SV.survey(lines, "id")
    got = {(r["path"], r["type"]): (r["n"], r["first"], r["last"]) for r in found.collect()}
    assert got == {
        ("a", "ARRAY"): (2, "2024-01", "2024-02"), ("a[].b", "BIGINT"): (1, "2024-01", "2024-01"),
        ("a[].b", "STRING"): (1, "2024-02", "2024-02"), ("c", "VOID"): (1, "2024-01", "2024-01"),
    }
    assert {r["path"] for r in SV.type_conflicts(found).collect()} == {"a[].b"}
