"""Contract-checked JSON flattening."""

from dataclasses import replace

from pyspark.sql import functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import loading as LD
from trackmetrics.operators import quality as Q
from trackmetrics.operators import structure as SV
from trackmetrics.plans.registry import query
from trackmetrics.session import materialise, work_folder
from trackmetrics.sources.layout import has_partitions, read_partitioned, write_rebalanced
from trackmetrics.sources.views import loadable_json, raw_json

ROUTED = """
    WITH r AS (SELECT *, CASE WHEN truncated THEN 'json_invalide' WHEN drift THEN 'type_modifie:tm.release_name'
                              WHEN no_track THEN 'champ_disparu:tm.track_name' END AS reason FROM raw_listens),
         p AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'rebut' WHEN private_flag THEN 'incognito' ELSE 'aplati' END AS category FROM r)"""


def parsed(t):
    return CT.parse(raw_json(t), CT.LISTENS)


@query("prj11_row_router", ROUTED + "SELECT category, reason, count(*) AS n FROM p GROUP BY 1, 2")
def row_router(t):
    return CT.reasons(parsed(t))


@query("prj13_nested_projection", """
    SELECT msid, artist_name AS credit, md5(artist_name) AS artist_mbid, count(*) AS n FROM raw_listens
    WHERE mbid IS NOT NULL AND NOT truncated GROUP BY ALL""")
def nested_projection(t):
    lines = parsed(t).where("valid_json")
    artists = F.col("e.track_metadata.mbid_mapping.artists")
    names = lines.select(
        F.col("e.recording_msid").alias("msid"), F.explode(F.arrays_zip(
            F.transform(artists, lambda a: a["artist_credit_name"]).alias("credit"), F.transform(artists, lambda a: a["artist_mbid"]).alias("artist_mbid"),
        )).alias("a"))
    return names.groupBy("msid", F.col("a.credit").alias("credit"), F.col("a.artist_mbid").alias("artist_mbid")).agg(n_rows().alias("n"))


@query("prj14_tolerant_cast", """
    SELECT count(*) AS n, count(*) AS present, count(*) FILTER (k % 13 = 0) AS failed FROM raw_listens WHERE NOT truncated""")
def tolerant_cast(t):
    return CT.conversion_failures(parsed(t).where("valid_json"))


@query("ct1_compiled_schema", """
    SELECT count(*) FILTER (NOT truncated) AS user_id, count(*) FILTER (NOT truncated) AS timestamp, count(*) FILTER (NOT truncated) AS recording_msid,
           count(*) FILTER (NOT truncated) AS track_metadata FROM raw_listens""")
def compiled_schema(t):
    """Root fields of the schema compiled from the contract, with the lines that fill them."""
    lines = parsed(t).where("valid_json")
    return lines.agg(*[F.count(f"e.{f.name}").alias(f.name) for f in CT.schema(CT.LISTENS).fields])


@query("ct2_parse_and_reject", ROUTED + """
    SELECT count(*) AS n, count(*) FILTER (reason = 'json_invalide') AS invalid_json, count(*) FILTER (reason = 'type_non_conforme') AS wrong_type FROM p""")
def parse_and_reject(t):
    return parsed(t).agg(
        n_rows().alias("n"), F.count_if(F.col("reason") == "json_invalide").alias("invalid_json"),
        F.count_if(F.col("reason") == "type_non_conforme").alias("wrong_type"),
    )


@query("ct3_unknown_keys", """
    SELECT 'ai.ip_addr' AS key, count(*) AS n FROM raw_listens WHERE has_ip AND NOT truncated UNION ALL
    SELECT 'ai.new_key', count(*) FROM raw_listens WHERE has_new AND NOT truncated UNION ALL
    SELECT 'ai.origin_url', count(*) FROM raw_listens WHERE discarded AND NOT truncated""")
def unknown_keys(t):
    return CT.unknown_key_totals(raw_json(t), CT.LISTENS).where("key IS NOT NULL")


@query("ct4_type_drift", "SELECT event_id, 'tm.release_name' AS fields FROM raw_listens WHERE drift AND NOT truncated")
def type_drift(t):
    drifted = parsed(t).where(F.size("drift") > 0)
    return drifted.select("event_id", F.array_join("drift", ",").alias("fields"))


@query("ct5_missing_required", "SELECT event_id FROM raw_listens WHERE no_track AND NOT truncated AND NOT drift")
def missing_required(t):
    return parsed(t).where(F.col("reason").startswith("champ_disparu:")).select("event_id")


@query("ct6_key_policy", """
    SELECT 'interdite' AS family, 'ai.ip_addr' AS key, count(*) AS n FROM raw_listens WHERE has_ip AND NOT truncated UNION ALL
    SELECT 'nouvelle', 'ai.new_key', count(*) FROM raw_listens WHERE has_new AND NOT truncated UNION ALL
    SELECT 'ecartee', 'ai.origin_url', count(*) FROM raw_listens WHERE discarded AND NOT truncated""")
def key_policy(t):
    keys = CT.unknown_key_totals(raw_json(t), CT.LISTENS).where("key IS NOT NULL")
    return keys.select(CT.key_policy(CT.LISTENS, F.col("key")).alias("family"), "key", "n")


@query("ct7_absent_fields", """
    WITH r AS (SELECT * FROM raw_listens WHERE NOT truncated)
    SELECT 'tm.release_name' AS field, count(*) AS present FROM r UNION ALL SELECT 'tm.additional_info', count(*) FROM r UNION ALL
    SELECT 'tm.mbid_mapping', count(mbid) FROM r UNION ALL SELECT 'ai.recording_mbid', count(mbid) FROM r UNION ALL
    SELECT 'ai.duration_ms', count(*) FROM r UNION ALL SELECT 'ai.tracknumber', count(*) FROM r UNION ALL
    SELECT 'ai.incognito_mode', count(*) FILTER (private_flag) FROM r UNION ALL SELECT 'mm.recording_mbid', count(mbid) FROM r UNION ALL
    SELECT 'mm.artists', count(mbid) FROM r UNION ALL SELECT 'absent', 33""")
def absent_fields(t):
    found = CT.absent_fields(parsed(t).where("valid_json"), CT.LISTENS)
    missing = found.where("present = 0").agg(n_rows().alias("present")).select(F.lit("absent").alias("field"), "present")
    return found.where("present > 0").unionByName(missing)


@query("ct8_drift_tolerance", ROUTED + """
    SELECT 'TYPE_MODIFIE' AS "check", 'tm.release_name' AS detail, count(*) FILTER (reason LIKE 'type_modifie%') AS n,
           CASE WHEN count(*) FILTER (reason LIKE 'type_modifie%') <= 0.0001 * count(*) THEN 0 ELSE 1 END AS failed FROM p""")
def drift_tolerance(t):
    checks = CT.verdict(CT.measures(parsed(t)), CT.LISTENS).where(F.col("check") == "TYPE_MODIFIE")
    return checks.withColumn("failed", F.col("failed").cast("int"))


#: The listen contract with room for the drifted lines of a loadable batch (a seven-hundredth of all).
TOLERANT = replace(CT.LISTENS, drift_rate=0.01)

_LOADABLE = ROUTED + """,
         b AS (SELECT * FROM p WHERE NOT (has_ip OR has_new OR no_track)),
         c AS (SELECT count(*) AS n, count(*) FILTER (category = 'aplati') AS kept, count(*) FILTER (category = 'rebut') AS rejected,
                      count(*) FILTER (category = 'incognito') AS private, count(DISTINCT (user_tok, ts_s, msid)) FILTER (category = 'aplati') AS written FROM b),
         a AS (SELECT count(*) AS n, count(*) FILTER (category = 'aplati') AS kept, count(*) FILTER (category = 'rebut') AS rejected,
                      count(*) FILTER (category = 'incognito') AS private FROM p)"""


@query("ct9_all_or_nothing", _LOADABLE + """
    SELECT '1' AS dump, 'REFUSE' AS outcome, n AS n_read, n AS expected, kept, rejected, private, 0 AS written, 0 AS duplicates, 0 AS bad_routing, 0 AS stored FROM a UNION ALL
    SELECT '2', 'REFUSE', n, n, kept, rejected, private, 0, 0, 0, 0 FROM c UNION ALL
    SELECT '3', 'REFUSE', n, n + 1, kept, rejected, private, 0, 0, 0, 0 FROM c UNION ALL
    SELECT '4', 'CONTROLE_OK', n, n, kept, rejected, private, 0, 0, 0, 0 FROM c UNION ALL
    SELECT '5', 'APLATI_OK', n, n, kept, rejected, private, written, kept - written, 0, written FROM c UNION ALL
    SELECT '5', 'APLATI_ECHEC', 2 * n, 2 * n, 2 * kept, 2 * rejected, 2 * private, written, 2 * kept - written, 0, written FROM c""")
def all_or_nothing(t):
    """Refused for defects, for drift beyond the tolerance and for a wrong count; controlled only; loaded with tolerated drift and
    rejects; reloaded with every line twice, which fails the check of what was written.  ``stored`` is what the table holds of the batch afterwards.
    Lines that are loaded more than once are parsed once."""
    lines, fit = materialise(raw_json(t).drop("event_id"), "ct9"), materialise(loadable_json(t), "ct9-fit")
    n_all, n_fit = lines.count(), fit.count()
    target, rejected = work_folder(t.spark, "ct9"), work_folder(t.spark, "ct9-rejects")
    day = t.listens.agg(F.max("date").cast("string")).first()[0]

    parsed_fit = LD.parse_batch(fit, TOLERANT)

    def run(dump, batch, contract, expected, **how):
        report = LD.load_batch(batch, contract, dump, day, target, rejected, expected, **how)
        stored = read_partitioned(t.spark, target).where(F.col("dump") == dump).count() if has_partitions(t.spark, target) else 0
        return report.withColumn("stored", F.lit(stored).cast("long"))

    return Q.union(
        run("1", lines, CT.LISTENS, n_all),
        run("2", fit, CT.LISTENS, n_fit, parsed=parsed_fit),
        run("3", fit, TOLERANT, n_fit + 1, parsed=parsed_fit),
        run("4", fit, TOLERANT, n_fit, control_only=True, parsed=parsed_fit),
        run("5", fit, TOLERANT, n_fit, parsed=parsed_fit),
        run("5", fit.unionByName(fit), TOLERANT, 2 * n_fit, max_duplicates=0.25, parsed=parsed_fit.unionByName(parsed_fit)),
    )


@query("ct10_empty_batch", _LOADABLE + """
    SELECT '1' AS dump, 'DUMP_VIDE' AS outcome, 0 AS n_read, 0 AS expected, 0 AS kept, 0 AS rejected, 0 AS private, 0 AS written, 0 AS duplicates, 0 AS bad_routing UNION ALL
    SELECT '2', 'REFUSE', 0, 5, 0, 0, 0, 0, 0, 0 UNION ALL
    SELECT '3', 'VIDE_NON_ATTENDU', private, private, 0, 0, private, 0, 0, 0 FROM c""")
def empty_batch(t):
    """Nothing read and nothing announced is a valid batch; any other empty output fails."""
    lines = raw_json(t).drop("event_id")
    none = lines.where("false")
    hidden = t.raw_listens.where("private_flag AND NOT (has_ip OR has_new OR no_track OR truncated OR drift)").select("event_id")
    private = materialise(raw_json(t).join(hidden, "event_id", "left_semi").drop("event_id"), "ct10")
    target, rejected = work_folder(t.spark, "ct10"), work_folder(t.spark, "ct10-rejects")
    return Q.union(
        LD.load_batch(none, CT.LISTENS, "1", "2024-01-31", target, rejected, 0),
        LD.load_batch(none, CT.LISTENS, "2", "2024-01-31", target, rejected, 5),
        LD.load_batch(private, CT.LISTENS, "3", "2024-01-31", target, rejected, private.count()),
    )


@query("ct11_flatten", ROUTED + """
    SELECT user_tok AS user_id, ts_s AS timestamp, CAST(date AS STRING) AS date, mois, msid AS recording_msid, artist_name, track_name,
           concat('Record no. ', k % 4) AS release_name, mbid AS mbid_enregistrement, CASE WHEN mbid IS NOT NULL THEN 'recording_mbid' END AS mbid_provenance,
           CASE WHEN k % 13 <> 0 THEN k % 17 + 1 END AS tracknumber, k * 997 + 61000 AS duration_ms,
           CASE WHEN mbid IS NOT NULL THEN artist_name END AS first_credit FROM p WHERE category = 'aplati'""")
def flatten(t):
    flat = CT.flatten(parsed(t))
    return flat.select(
        "user_id", "timestamp", F.col("date").cast("string").alias("date"), "mois", "recording_msid", "artist_name", "track_name", "release_name",
        "mbid_enregistrement", "mbid_provenance", "tracknumber", "duration_ms", F.get("mm_artistes", F.lit(0))["artist_credit_name"].alias("first_credit"),
    )


@query("ct12_verify_written", ROUTED + """
    SELECT count(*) AS n, count(DISTINCT mois) AS months, 0 AS bad_tokens, 0 AS bad_dates, count(mbid) AS with_mbid,
           count(*) FILTER (k % 13 <> 0) AS with_tracknumber, count(mbid) AS from_recording, '' AS leaked_columns,
           (SELECT count(*) FROM p WHERE category = 'rebut') AS rejects FROM p WHERE category = 'aplati'""")
def verify_written(t):
    """Write the flattened lines and the rejects, then check what was written."""
    lines = parsed(t)
    target, rejected = work_folder(t.spark, "ct12"), work_folder(t.spark, "ct12-rejects")
    write_rebalanced(CT.flatten(lines), target, ["mois"])
    write_rebalanced(CT.rejects(lines), rejected, ["mois"])
    n_rejects = read_partitioned(t.spark, rejected).agg(n_rows()).scalar()
    return CT.verify_flat(read_partitioned(t.spark, target), CT.LISTENS).withColumn("rejects", n_rejects)


@query("ct13_minimise", """
    SELECT count(*) AS n, count(*) FILTER (NOT truncated) AS rewritten, 0 AS with_ip, 0 AS with_new, 0 AS with_dropped,
           count(*) FILTER (drift AND NOT truncated) AS numbers_kept, count(mbid) FILTER (NOT truncated) AS with_mbid FROM raw_listens""")
def minimise(t):
    v = F.col("value")
    return CT.minimise(raw_json(t), CT.LISTENS).agg(
        n_rows().alias("n"), F.count(v).alias("rewritten"), F.count_if(v.contains("ip_addr")).alias("with_ip"),
        F.count_if(v.contains("new_key")).alias("with_new"), F.count_if(v.contains("origin_url")).alias("with_dropped"),
        F.count_if(v.contains('"release_name":77')).alias("numbers_kept"),
        F.count(F.get_json_object(v, "$.track_metadata.additional_info.recording_mbid")).alias("with_mbid"),
    )


@query("ct14_altered_batches", """
    WITH r AS (SELECT *, event_id % 10 = 0 AS hit FROM raw_listens WHERE NOT truncated)
    SELECT batch, count(*) FILTER (batch = 'champ_nouveau' AND hit) AS new_key, count(*) FILTER (batch = 'champ_purge' AND hit) AS purged,
           count(*) FILTER (drift OR (batch = 'type_modifie' AND hit)) AS drifted,
           count(*) FILTER (NOT drift AND NOT (batch = 'type_modifie' AND hit) AND (no_track OR (batch = 'champ_disparu' AND hit))) AS gone
    FROM r, (VALUES ('temoin'), ('champ_nouveau'), ('type_modifie'), ('champ_disparu'), ('champ_purge')) AS c(batch) GROUP BY batch""")
def altered_batches(t):
    """Every tenth line altered in five ways; the parser must see each alteration.

    Lines left as they are look the same in the five batches, so they are parsed once and their counts added to each.
    """
    lines = materialise(raw_json(t), "ct14")
    hit = F.col("event_id") % 10 == 0

    def counts(df):
        p = CT.parse(df, CT.LISTENS).where("valid_json")
        return p.agg(
            F.count_if(F.array_contains("unknown", "racine.essai_inconnu")).alias("new_key"),
            F.count_if(F.array_contains("unknown", "ai.conn_country")).alias("purged"),
            F.count_if(F.size("drift") > 0).alias("drifted"), F.count_if(F.col("reason").startswith("champ_disparu:")).alias("gone"),
        )

    left = counts(lines.where(~F.coalesce(hit, F.lit(False)))).agg(F.struct(*[F.sum(c).alias(c) for c in _SEEN])).scalar()
    out = [
        counts(CT.alter(lines.where(hit), case, hit)).select(F.lit(case).alias("batch"), *[(F.col(c) + left.getField(c)).alias(c) for c in _SEEN])
        for case in CT.ALTERATIONS
    ]
    return Q.union(*out)


_SEEN = ("new_key", "purged", "drifted", "gone")


@query("src15_raw_zone_check", """
    WITH r AS (SELECT *, CASE WHEN event_id % 241 = 0 THEN concat('X', user_tok) ELSE user_tok END AS tok FROM raw_listens)
    SELECT count(*) AS n, count(DISTINCT tok) FILTER (NOT truncated) AS listeners, count(mbid) FILTER (NOT truncated) AS with_mbid,
           min(ts_s) FILTER (NOT truncated) AS ts_min, max(ts_s) FILTER (NOT truncated) AS ts_max,
           count(*) FILTER (truncated) AS rejects, count(*) FILTER (has_ip AND NOT truncated) AS forbidden,
           count(*) FILTER (event_id % 241 = 0 AND NOT truncated) AS bad_tokens, count(*) FILTER (event_id % 251 = 0 AND NOT truncated) AS outside_day FROM r""")
def raw_zone_check(t):
    """Write the raw lines by day, some with a bad token or under the wrong day, read them back as text and check them."""
    path = work_folder(t.spark, "src15")
    bad_token = F.replace("value", F.lit('"user_id":"'), F.lit('"user_id":"X'))
    lines = raw_json(t).select(
        F.when(F.col("event_id") % 251 == 0, F.date_add("date", 1)).otherwise(F.col("date")).alias("date"),
        F.when(F.col("event_id") % 241 == 0, bad_token).otherwise(F.col("value")).alias("value"),
    )
    lines.write.partitionBy("date").text(path)
    return CT.raw_audit(t.spark.read.option("basePath", path).text(path), "date")


@query("src16_structure_survey", """
    WITH r AS (SELECT * FROM raw_listens WHERE NOT truncated)
    SELECT path, type, count(*) AS n, min(mois) AS first, max(mois) AS last FROM (
        SELECT mois, x.p AS path, x.t AS type FROM (SELECT mois, unnest([{'p': 'user_id', 't': 'STRING'}, {'p': 'timestamp', 't': 'BIGINT'}, {'p': 'recording_msid', 't': 'STRING'},
            {'p': 'track_metadata.artist_name', 't': 'STRING'}, {'p': CASE WHEN NOT no_track THEN 'track_metadata.track_name' END, 't': 'STRING'},
            {'p': 'track_metadata.release_name', 't': CASE WHEN drift THEN 'BIGINT' ELSE 'STRING' END},
            {'p': CASE WHEN mbid IS NOT NULL THEN 'track_metadata.additional_info.recording_mbid' END, 't': 'STRING'},
            {'p': 'track_metadata.additional_info.duration_ms', 't': 'BIGINT'}, {'p': 'track_metadata.additional_info.tracknumber', 't': 'STRING'},
            {'p': CASE WHEN private_flag THEN 'track_metadata.additional_info.incognito_mode' END, 't': 'BOOLEAN'},
            {'p': CASE WHEN has_ip THEN 'track_metadata.additional_info.ip_addr' END, 't': 'STRING'},
            {'p': CASE WHEN has_new THEN 'track_metadata.additional_info.new_key' END, 't': 'BIGINT'},
            {'p': CASE WHEN discarded THEN 'track_metadata.additional_info.origin_url' END, 't': 'STRING'},
            {'p': CASE WHEN mbid IS NOT NULL THEN 'track_metadata.mbid_mapping.recording_mbid' END, 't': 'STRING'},
            {'p': CASE WHEN mbid IS NOT NULL THEN 'track_metadata.mbid_mapping.artists' END, 't': 'ARRAY'},
            {'p': CASE WHEN mbid IS NOT NULL THEN 'track_metadata.mbid_mapping.artists[].artist_mbid' END, 't': 'STRING'},
            {'p': CASE WHEN mbid IS NOT NULL THEN 'track_metadata.mbid_mapping.artists[].artist_credit_name' END, 't': 'STRING'},
            {'p': CASE WHEN mbid IS NOT NULL THEN 'track_metadata.mbid_mapping.artists[].join_phrase' END, 't': 'STRING'}]) AS x FROM r) AS z) AS y
    WHERE path IS NOT NULL GROUP BY path, type""")
def structure_survey(t):
    return SV.survey(raw_json(t), "event_id").drop("months")


@query("src16_type_conflicts", """
    WITH r AS (SELECT CASE WHEN drift THEN 'BIGINT' ELSE 'STRING' END AS type, mois FROM raw_listens WHERE NOT truncated),
         n AS (SELECT type, count(*) AS n, min(mois) AS first, max(mois) AS last FROM r GROUP BY type)
    SELECT 'track_metadata.release_name' AS path, type, n, first, last FROM n WHERE (SELECT count(*) FROM n) > 1""")
def type_conflicts(t):
    """Paths that hold more than one type, with the lines and months of each."""
    return SV.type_conflicts(SV.survey(raw_json(t), "event_id")).select("path", "type", "n", "first", "last")


@query("src16_forbidden_paths", """
    SELECT 'track_metadata.additional_info.ip_addr' AS path, 'STRING' AS type, count(*) AS n, min(mois) AS first, max(mois) AS last
    FROM raw_listens WHERE has_ip AND NOT truncated HAVING count(*) > 0""")
def forbidden_paths(t):
    """Paths whose last name the contract forbids or purges at some level."""
    names = CT.LISTENS.forbidden.union(*[level.purged for level in CT.LISTENS.levels.values()])
    return SV.forbidden_paths(SV.survey(raw_json(t), "event_id"), sorted(names)).select("path", "type", "n", "first", "last")
