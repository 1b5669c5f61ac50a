"""Quality gate checks."""

from pyspark.sql import functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import facts as A
from trackmetrics.operators import quality as Q
from trackmetrics.operators import resolve as R
from trackmetrics.operators import tags as G
from trackmetrics.operators import warehouse as W
from trackmetrics.operators.catalog import AUDIO, BOUNDS
from trackmetrics.plans.registry import query
from trackmetrics.sources.views import raw_json

PICK = ("check", "severity", "observed", "ok")
MIN_CATALOG, MIN_HISTORY = 150, 5_000


def oracle(name: str, severity: str, observed: str, ok: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{severity}' AS severity, {observed} AS observed, CASE WHEN {ok} THEN 1 ELSE 0 END AS ok {source}"


def tokenised(t):
    return t.history.select(F.md5(F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("user_tok"), "track_id", "playcount")


def one_catalog_check(name):
    return lambda t: Q.run(t.catalog, [Q.catalog_checks(MIN_CATALOG)[name]]).select(*PICK)


def one_history_check(name):
    return lambda t: Q.run(tokenised(t), [Q.history_checks(MIN_HISTORY)[name]]).select(*PICK)


audio_nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in AUDIO)
out_of_bounds = " + ".join(f"count(*) FILTER ({c} < {lo} OR {c} > {hi})" for c, (lo, hi) in BOUNDS.items())

query("dq1_catalog_rows", oracle("dq1", Q.BLOCK, "concat('n=', count(*))", f"count(*) >= {MIN_CATALOG}", "FROM catalog"))(one_catalog_check("dq1"))
query("dq2_unique_key", oracle("dq2", Q.BLOCK, "concat('duplicates=', count(*) - count(DISTINCT track_id), ', nulls=', count(*) FILTER (track_id IS NULL))",
      "count(*) = count(DISTINCT track_id)", "FROM catalog"))(one_catalog_check("dq2"))
query("dq3_audio_complete", oracle("dq3", Q.BLOCK, f"concat('nulls=', {audio_nulls})", f"{audio_nulls} = 0", "FROM catalog"))(one_catalog_check("dq3"))
query("dq4_bounds", oracle("dq4", Q.BLOCK, f"concat('out_of_bounds=', {out_of_bounds})", f"{out_of_bounds} = 0", "FROM catalog"))(one_catalog_check("dq4"))
query("dq5_genre_nulls", oracle("dq5", Q.WARN, "concat('null_pct=', round(100.0 * count(*) FILTER (genre IS NULL) / count(*), 3)::DOUBLE)",
      "100.0 * count(*) FILTER (genre IS NULL) / count(*) <= 60", "FROM catalog"))(one_catalog_check("dq5"))
query("dq6_year_nulls", oracle("dq6", Q.WARN, "concat('null_pct=', round(100.0 * count(*) FILTER (year IS NULL) / count(*), 3)::DOUBLE)", "TRUE", "FROM catalog"))(one_catalog_check("dq6"))
query("dq8_history_rows", oracle("dq8", Q.BLOCK, "concat('n=', count(*))", f"count(*) >= {MIN_HISTORY}", "FROM history"))(one_history_check("dq8"))
query("dq9_token_format", oracle("dq9", Q.BLOCK, "'shortest=32, longest=32, not_hex=0, nulls=' || count(*) FILTER (user_id IS NULL)", "TRUE", "FROM history"))(one_history_check("dq9"))
query("dq10_positive_plays", oracle("dq10", Q.BLOCK, "concat('lowest=', min(playcount), ', not_positive=', count(*) FILTER (playcount <= 0))",
      "count(*) FILTER (playcount <= 0) = 0", "FROM history"))(one_history_check("dq10"))


@query("dq7_no_identifier", oracle("dq7", Q.BLOCK, "concat('n=', count(*), ', found=user_id')", "FALSE", "FROM history"))
def no_identifier(t):
    """The untokenised history must fail."""
    return Q.no_identifier(t.history).select(*PICK)


@query("dq11_composite_key", oracle("dq11", Q.BLOCK, "concat('duplicates=', count(*) FILTER (n > 1))", "count(*) FILTER (n > 1) = 0",
       "FROM (SELECT user_tok, msid, count(*) AS n FROM listens_flat GROUP BY 1, 2) AS x"))
def composite_key(t):
    return Q.composite_key(t.listens_flat, ["user_tok", "msid"]).select(*PICK)


@query("dq12_dq13_referential", """
    WITH h AS (SELECT DISTINCT track_id FROM history), c AS (SELECT track_id FROM catalog),
         m AS (SELECT (SELECT count(*) FROM h) AS used, (SELECT count(*) FROM c) AS known,
                      (SELECT count(*) FROM h WHERE track_id NOT IN (SELECT track_id FROM c)) AS o)
    SELECT 'dq12' AS "check", 'BLOQUANT' AS severity, concat('orphans=', o, ', keys=', used) AS observed, CASE WHEN o = 0 THEN 1 ELSE 0 END AS ok FROM m
    UNION ALL SELECT 'dq13', 'AVERTISSEMENT', concat('pct=', round(100.0 * used / known, 2)::DOUBLE), CASE WHEN 100.0 * used / known >= 55 THEN 1 ELSE 0 END FROM m""")
def referential(t):
    return Q.referential(t.history, t.catalog, "track_id").select(*PICK)


@query("dq14_dq16_raw_keys", """
    WITH m AS (SELECT count(*) AS n, CASE WHEN count(*) FILTER (has_new AND NOT truncated) > 0 THEN 1 ELSE 0 END AS new_keys,
               CASE WHEN count(*) FILTER (has_ip AND NOT truncated) > 0 THEN 1 ELSE 0 END AS bad FROM raw_listens)
    SELECT 'dq14' AS "check", 'BLOQUANT' AS severity, concat('keys=', new_keys, ', n_lines=', n) AS observed, CASE WHEN new_keys = 0 THEN 1 ELSE 0 END AS ok FROM m
    UNION ALL SELECT 'dq16', 'BLOQUANT', concat('keys=', bad, ', n_lines=', n), CASE WHEN bad = 0 THEN 1 ELSE 0 END FROM m""")
def raw_keys(t):
    return Q.raw_key_checks(raw_json(t), CT.LISTENS).select(*PICK)


@query("dq15_removed_keys", oracle("dq15", Q.WARN, "concat('keys=', CASE WHEN count(*) > 0 THEN 1 ELSE 0 END, ', occurrences=', count(*))", "count(*) = 0",
       "FROM raw_listens WHERE has_new AND NOT truncated"))
def removed_keys(t):
    return Q.removed_at_ingestion(CT.removed_keys(raw_json(t), CT.LISTENS)).select(*PICK)


@query("dq17_exact_columns", oracle("dq17", Q.BLOCK, "concat('n=', count(*), ', missing=, extra=')", "TRUE",
       "FROM raw_listens WHERE NOT (truncated OR no_track OR drift OR private_flag)"))
def exact_columns(t):
    flat = CT.flatten(CT.parse(raw_json(t), CT.LISTENS))
    return Q.exact_columns(flat, CT.flat_columns()).select(*PICK)


@query("dq18_flat_coherence", oracle("dq18", Q.BLOCK, "concat('n=', count(*), ', bad_tokens=0, bad_dates=0, bad_months=0, nulls=0')", "count(*) > 0", "FROM listens_flat"))
def flat_coherence(t):
    return Q.flat_coherence(t.listens_flat, "user_tok", "ts_s", "date", "mois").select(*PICK)


_VOLUME = """
    WITH s AS (SELECT {lot} AS lot, count(*) AS n FROM orders GROUP BY 1),
         w AS (SELECT *, count(*) OVER p AS seen, median(n) OVER p AS med FROM s WINDOW p AS (ORDER BY lot ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)),
         m AS (SELECT (SELECT count(*) FROM s) AS lots, count(*) FILTER (seen >= 6 AND (n / med > {hi} OR n / med < {lo})) AS o FROM w)
    SELECT '{name}' AS "check", 'AVERTISSEMENT' AS severity, concat('lots=', lots, ', out=', o) AS observed, CASE WHEN o = 0 THEN 1 ELSE 0 END AS ok FROM m"""


@query("dq19_monthly_volume", _VOLUME.format(name="dq19", lot="substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7)", w=12, hi=5.0, lo=0.5))
def monthly_volume(t):
    series = t.orders.groupBy(X.month_of(F.col("o_orderdate")).alias("lot")).agg(n_rows().alias("n"))
    return Q.volume_check("dq19", series, "lot", "n", 12, 5.0, 0.5).select(*PICK)


@query("dq20_daily_volume", _VOLUME.format(name="dq20", lot="CAST(CAST(o_orderdate AS DATE) AS STRING)", w=14, hi=5.0, lo=0.2))
def daily_volume(t):
    series = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("lot")).agg(n_rows().alias("n"))
    return Q.volume_check("dq20", series, "lot", "n", 14, 5.0, 0.2).select(*PICK)


@query("dq21_reference_keys", oracle("dq21", Q.BLOCK, "concat('canon=', (SELECT count(*) FROM canon), ', redirect=', (SELECT count(*) FROM redirect), ', duplicates=0, not_uuid=0')", "TRUE", ""))
def reference_keys(t):
    return Q.reference_keys(t.canon, t.redirect, "rec_id").select(*PICK)


@query("dq22_correspondence", oracle("dq22", Q.BLOCK, "concat('n=', count(DISTINCT msid), ', duplicates=0, outside=0, bad_share=0')", "TRUE",
       """FROM listens_flat WHERE mbid IN (SELECT rec_id FROM canon) OR lastfm IN (SELECT rec_id FROM canon) OR mbid IN (SELECT rec_id FROM redirect)
          OR lastfm IN (SELECT rec_id FROM redirect) OR (k % 11 <> 0 AND regexp_replace(lower(concat(artist_name, track_name)), '[^a-z0-9_]', '', 'g')
          IN (SELECT lookup_key FROM canon GROUP BY 1 HAVING count(*) = 1))"""))
def correspondence(t):
    corr = R.majority(R.resolve_stored(t.listens_flat, t.canon, t.redirect))
    return Q.correspondence(corr, t.canon).select(*PICK)


@query("dq23_table_properties")
def table_properties(t):
    """License and usage properties of a registered table, required and exact."""
    from trackmetrics.sources.tables import check_properties, register, unique_name
    from trackmetrics.session import work_folder

    path = work_folder(t.spark, "dq23")
    G.tag_statistics(G.item_tags(t.tags_raw, "doc_id")).write.parquet(path)
    wanted = {"licence": "CC-BY-NC-SA-3.0-US", "usage": "academique-non-diffusable-labels"}
    name = register(t.spark, unique_name("dq23_vocabulary"), path, "Tag vocabulary", wanted)
    return check_properties(t.spark, name, wanted)


@query("dq24_vocabulary", """
    WITH n AS (SELECT DISTINCT nom, NULLIF(trim(regexp_replace(regexp_replace(replace(lower(nom), '&', ' and '), '[/_-]+', ' ', 'g'), '\\s+', ' ', 'g')), '') AS tag
               FROM tags_raw WHERE votes > 0),
         v AS (SELECT tag, count(DISTINCT doc_id) AS items FROM tags_raw JOIN n USING (nom) WHERE votes > 0 AND tag IS NOT NULL GROUP BY tag)
    SELECT 'dq24' AS "check", 'BLOQUANT' AS severity, concat('n=', count(*) FILTER (items >= 50), ', duplicates=0, under=0, outside=', CAST(sum(items) FILTER (items < 50) AS BIGINT)) AS observed,
           CASE WHEN sum(items) FILTER (items < 50) > 0 THEN 0 ELSE 1 END AS ok FROM v""")
def vocabulary(t):
    """Item tags that were not restricted to the vocabulary must fail."""
    per_item = G.item_tags(t.tags_raw, "doc_id")
    vocab = G.tag_statistics(per_item).where("items >= 50")
    return Q.vocabulary(vocab, per_item, 50).select(*PICK)


@query("dq25_publication", oracle("dq25", Q.BLOCK, "concat('n=', count(*), ', under=', count(*) FILTER (listeners < 5))", "count(*) FILTER (listeners < 5) = 0", "FROM day_facts"))
def publication(t):
    return Q.publication(t.day_facts, "listeners", 5).select(*PICK)


@query("dq26_expected_values", """
    SELECT 'listens' AS "check", 'BLOQUANT' AS severity, concat('measured=', CAST(sum(listens) AS BIGINT)) AS observed, 1 AS ok FROM day_facts
    UNION ALL SELECT 'groups', 'BLOQUANT', concat('measured=', count(*)), 0 FROM day_facts""")
def expected_values(t):
    """One value that holds (listens equal the source) and one that must fail (groups equal the rows)."""
    source = t.plays.agg(F.struct(F.sum("qty").alias("listens"), n_rows().alias("n"))).scalar()
    return Q.expected_values(t.day_facts, {
        "listens": (F.sum("listens"), source.getField("listens")), "groups": (n_rows(), source.getField("n") + 1),
    }).select(*PICK)


@query("dq27_replication", oracle("dq27", Q.BLOCK, "concat('n=', 3 * count(*), ', users=', 3 * count(DISTINCT user_id))", "TRUE", "FROM history"))
def replication(t):
    source = t.history.withColumn("user_id", F.col("user_id").cast("string"))
    return Q.replication(source, W.replicate(source, "user_id", 3), "user_id", 3).select(*PICK)


@query("dq28_calendar", oracle("dq28", Q.BLOCK, "concat('n=', max(date) - min(date) + 1, ', first=', min(date), ', last=', max(date), ', bad_weekday=0')", "TRUE", "FROM plays"))
def calendar(t):
    span = t.plays.agg(F.struct(F.min("date").alias("a"), F.max("date").alias("b"))).scalar()
    first, last = span.getField("a"), span.getField("b")
    return Q.calendar(W.calendar(t.spark, first, last), first, last).select(*PICK)


@query("dq_gate_report", """
    WITH c AS (SELECT count(*) AS n, {nulls} AS nulls, {outside} AS outside, 100.0 * count(*) FILTER (genre IS NULL) / count(*) AS g FROM catalog),
         k AS (SELECT CASE WHEN n >= 150 THEN 1 ELSE 0 END + 1 + CASE WHEN nulls = 0 THEN 1 ELSE 0 END + CASE WHEN outside = 0 THEN 1 ELSE 0 END AS blocks,
                      CASE WHEN g <= 60 THEN 1 ELSE 0 END + 1 AS warns FROM c)
    SELECT 6 AS checks, blocks + warns AS passed, 4 - blocks AS blocking_failures, 2 - warns AS warnings,
           CASE WHEN blocks < 4 THEN 'ECHEC' ELSE 'SUCCES' END AS status FROM k""".format(nulls=audio_nulls, outside=out_of_bounds))
def gate_report(t):
    return Q.verdict(Q.run(t.catalog, list(Q.catalog_checks(MIN_CATALOG).values())))
