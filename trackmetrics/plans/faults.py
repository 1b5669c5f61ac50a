"""Quality checks over inputs with planted faults: each check must report them, and how many there are."""

from pyspark.sql import functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import loading
from trackmetrics.operators import quality as Q
from trackmetrics.operators import resolve as R
from trackmetrics.operators import warehouse as W
from trackmetrics.plans.quality import MIN_HISTORY, PICK, oracle
from trackmetrics.plans.registry import query
from trackmetrics.session import work_folder
from trackmetrics.sources.layout import read_partitioned
from trackmetrics.sources.views import raw_json

_TOKEN = "md5(concat('u', CAST(user_id AS STRING)))"
#: Upper-case, short and missing tokens among the others.
_FAULTY_TOKEN = f"CASE WHEN user_id % 40 = 3 THEN upper({_TOKEN}) WHEN user_id % 40 = 5 THEN substr({_TOKEN}, 1, 30) WHEN user_id % 40 <> 7 THEN {_TOKEN} END"


@query("dq9_faulty_tokens", oracle("dq9", Q.BLOCK, """concat('shortest=', min(length(tok)), ', longest=', max(length(tok)),
    ', not_hex=', count(*) FILTER (NOT regexp_full_match(tok, '[0-9a-f]+')), ', nulls=', count(*) FILTER (tok IS NULL))""",
    "min(length(tok)) = 32 AND count(*) FILTER (tok IS NULL OR NOT regexp_full_match(tok, '[0-9a-f]+')) = 0",
    f"FROM (SELECT {_FAULTY_TOKEN} AS tok FROM history) AS x"))
def faulty_tokens(t):
    history = t.history.selectExpr(f"{_FAULTY_TOKEN} AS user_tok", "track_id", "playcount")
    return Q.run(history, [Q.history_checks(MIN_HISTORY)["dq9"]]).select(*PICK)


@query("dq17_faulty_columns", oracle("dq17", Q.BLOCK, "concat('n=', count(*), ', missing=mois, extra=user_name')", "FALSE",
       "FROM raw_listens WHERE NOT (truncated OR no_track OR drift OR private_flag)"))
def faulty_columns(t):
    """A column of the contract is gone and another one is there."""
    flat = CT.flatten(CT.parse(raw_json(t), CT.LISTENS)).withColumnRenamed("mois", "user_name")
    return Q.exact_columns(flat, CT.flat_columns()).select(*PICK)


_FAULTY_LISTENS = [
    "CASE WHEN event_id % 100 = 1 THEN concat(user_tok, 'g') WHEN event_id % 100 = 5 THEN NULL ELSE user_tok END AS user_tok",
    "CASE WHEN event_id % 100 <> 4 THEN ts_s END AS ts_s",
    "CASE WHEN event_id % 100 = 2 THEN date + 1 ELSE date END AS date",
    "CASE WHEN event_id % 100 = 3 THEN '1999-01' ELSE mois END AS mois",
]


@query("dq18_faulty_listens", oracle("dq18", Q.BLOCK, """concat('n=', count(*), ', bad_tokens=', count(*) FILTER (user_tok IS NULL OR length(user_tok) <> 32),
    ', bad_dates=', count(*) FILTER (CAST(to_timestamp(ts_s) AS DATE) <> date), ', bad_months=', count(*) FILTER (strftime(date, '%Y-%m') <> mois),
    ', nulls=', count(*) FILTER (ts_s IS NULL OR date IS NULL))""", "FALSE", f"FROM (SELECT {', '.join(_FAULTY_LISTENS)} FROM listens_flat) AS x"))
def faulty_listens(t):
    return Q.flat_coherence(t.listens_flat.selectExpr(*_FAULTY_LISTENS), "user_tok", "ts_s", "date", "mois").select(*PICK)


@query("dq21_faulty_reference", """
    WITH c AS (SELECT CASE WHEN rec_id >= 'e' THEN concat('x', rec_id) ELSE rec_id END AS rec_id FROM canon
               UNION ALL SELECT rec_id FROM canon WHERE rec_id < '2'),
         k AS (SELECT 'c' AS t, rec_id FROM c UNION ALL SELECT 'r', rec_id FROM redirect)
    SELECT 'dq21' AS "check", 'BLOQUANT' AS severity, concat('canon=', count(*) FILTER (t = 'c'), ', redirect=', count(*) FILTER (t = 'r'),
           ', duplicates=', count(*) - count(DISTINCT (t, rec_id)), ', not_uuid=', count(*) FILTER (length(rec_id) <> 36)) AS observed,
           CASE WHEN count(*) = count(DISTINCT (t, rec_id)) AND count(*) FILTER (length(rec_id) <> 36) = 0 THEN 1 ELSE 0 END AS ok FROM k""")
def faulty_reference(t):
    """Repeated keys and keys that are no UUID in the reference table."""
    keys = t.canon.selectExpr("CASE WHEN rec_id >= 'e' THEN concat('x', rec_id) ELSE rec_id END AS rec_id")
    return Q.reference_keys(keys.unionByName(t.canon.where("rec_id < '2'").select("rec_id")), t.redirect, "rec_id").select(*PICK)


@query("dq22_faulty_correspondence", oracle("dq22", Q.BLOCK, """concat('n=', count(*) + count(*) FILTER (msid LIKE '%7'), ', duplicates=', count(*) FILTER (msid LIKE '%7'),
    ', outside=0, bad_share=', count(*) FILTER (msid LIKE '%3'))""", "count(*) FILTER (msid LIKE '%7' OR msid LIKE '%3') = 0", """FROM (SELECT DISTINCT msid
       FROM listens_flat WHERE mbid IN (SELECT rec_id FROM canon) OR lastfm IN (SELECT rec_id FROM canon) OR mbid IN (SELECT rec_id FROM redirect)
          OR lastfm IN (SELECT rec_id FROM redirect) OR (k % 11 <> 0 AND regexp_replace(lower(concat(artist_name, track_name)), '[^a-z0-9_]', '', 'g')
          IN (SELECT lookup_key FROM canon GROUP BY 1 HAVING count(*) = 1))) AS x"""))
def faulty_correspondence(t):
    """Some titles stand twice, the share of others is above one."""
    corr = R.majority(R.resolve_stored(t.listens_flat, t.canon, t.redirect))
    corr = corr.withColumn("share", F.when(F.col("msid").endswith("3"), F.lit(1.5)).otherwise(F.col("share")))
    return Q.correspondence(corr.unionByName(corr.where(F.col("msid").endswith("7"))), t.canon).select(*PICK)


@query("dq27_faulty_copies", oracle("dq27", Q.BLOCK, "concat('n=', 3 * count(*) FILTER (track_id % 50 <> 1), ', users=', 3 * count(DISTINCT user_id) FILTER (track_id % 50 <> 1))",
       "count(*) FILTER (track_id % 50 = 1) = 0", "FROM history"))
def faulty_copies(t):
    """Copies from which the listens of some tracks were lost."""
    source = t.history.withColumn("user_id", F.col("user_id").cast("string"))
    return Q.replication(source, W.replicate(source, "user_id", 3).where("track_id % 50 <> 1"), "user_id", 3).select(*PICK)


@query("dq28_faulty_calendar", """
    WITH e AS (SELECT min(date) AS lo, max(date) AS hi FROM plays),
         d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM e),
         k AS (SELECT * FROM d WHERE day(date) <> 13)
    SELECT 'dq28' AS "check", 'BLOQUANT' AS severity, concat('n=', count(*), ', first=', min(date), ', last=', max(date),
           ', bad_weekday=', count(*) FILTER (day(date) = 14)) AS observed, 0 AS ok FROM k""")
def faulty_calendar(t):
    """A calendar without its thirteenths, the day after counted as an eighth weekday."""
    span = t.plays.agg(F.struct(F.min("date").alias("a"), F.max("date").alias("b"))).scalar()
    first, last = span.getField("a"), span.getField("b")
    days = W.calendar(t.spark, first, last).where("day(date) <> 13")
    return Q.calendar(days.withColumn("weekday", F.when(F.day("date") == 14, 8).otherwise(F.col("weekday"))), first, last).select(*PICK)


@query("dq26_gated_write", f"""
    WITH v AS (SELECT mois, event_type FROM listens_flat),
         f AS (SELECT {', '.join(_FAULTY_LISTENS)} FROM listens_flat),
         s AS (SELECT count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
                      count(*) FILTER (event_type = 'view' AND mois NOT IN (SELECT mois FROM v WHERE event_type = 'click')) AS old_views FROM v)
    SELECT 'views' AS load, concat('n=', views, ', bad_tokens=0, bad_dates=0, bad_months=0, nulls=0') AS observed, 1 AS ok, 1 AS published, views AS stored FROM s
    UNION ALL
    SELECT 'faulty', (SELECT concat('n=', count(*), ', bad_tokens=', count(*) FILTER (user_tok IS NULL OR length(user_tok) <> 32),
           ', bad_dates=', count(*) FILTER (CAST(to_timestamp(ts_s) AS DATE) <> date), ', bad_months=', count(*) FILTER (strftime(date, '%Y-%m') <> mois),
           ', nulls=', count(*) FILTER (ts_s IS NULL OR date IS NULL)) FROM f), 0, 0, views FROM s
    UNION ALL SELECT 'clicks', concat('n=', clicks, ', bad_tokens=0, bad_dates=0, bad_months=0, nulls=0'), 1, 1, clicks + old_views FROM s""")
def gated_write(t):
    """Three loads of one table, measured while they are written: a sound one, a faulty one that is refused, and a sound one that replaces its months."""
    path = work_folder(t.spark, "dq26-gated")
    fields = ["user_tok", "ts_s", "date", "mois"]
    loads = {
        "views": t.listens_flat.where("event_type = 'view'").select(*fields), "faulty": t.listens_flat.selectExpr(*_FAULTY_LISTENS),
        "clicks": t.listens_flat.where("event_type = 'click'").select(*fields),
    }
    out = []
    for load, rows in loads.items():
        report = loading.gated_write(rows, path, ["mois"], [Q.coherence_check("user_tok", "ts_s", "date", "mois")])
        stored = read_partitioned(t.spark, path).agg(n_rows()).first()[0]  # before the next load
        out.append(report.select(F.lit(load).alias("load"), "observed", "ok", "published", F.lit(stored).alias("stored")))
    return Q.union(*out)
