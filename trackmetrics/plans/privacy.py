"""Privacy operators."""

import uuid

from pyspark.sql import functions as F

from trackmetrics.functions import tokens as TK
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import facts as A
from trackmetrics.operators import privacy as PV
from trackmetrics.operators import profiling as P
from trackmetrics.operators import quality as Q
from trackmetrics.operators import resolve as R
from trackmetrics.plans.registry import query
from trackmetrics.session import work_folder
from trackmetrics.sources.layout import read_partitioned, write_rebalanced
from trackmetrics.sources.tables import drop_partitions_before, register
from trackmetrics.sources.views import raw_json

# Test values, not secrets: real keys are passed by the caller.
SALT = "0123456789abcdef0123456789abcdef"
KEY = bytes(range(64))
_INNER, _OUTER = bytes(b ^ 0x36 for b in KEY).hex(), bytes(b ^ 0x5C for b in KEY).hex()


@query("pv1_salted_token", f"""
    SELECT substr(sha256(concat('{SALT}', CAST(user_id AS STRING))), 1, 32) AS token, track_id, playcount FROM history""")
def salted_token(t):
    return t.history.select(TK.salted_token(F.col("user_id"), SALT).alias("token"), "track_id", "playcount")


@query("pv2_hmac_token", f"""
    SELECT user_id, substr(sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode(CAST(user_id AS STRING))))), 1, 32) AS token
    FROM (SELECT DISTINCT user_id FROM history) AS u""")
def hmac_token(t):
    return t.history.select("user_id").distinct().select("user_id", TK.hmac_token(F.col("user_id"), KEY).alias("token"))


@query("pv3_collision_control", """
    SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) AS tokens, 0 AS null_users, 1 AS ok FROM history""")
def collision_control(t):
    return PV.collision_control(t.history, "user_id", TK.salted_token(F.col("user_id"), SALT, 128))


@query("pv4_key_strength", """
    SELECT 'short_salt' AS case_name, 1 AS refused, count(*) AS n FROM history UNION ALL SELECT 'odd_bits', 1, count(*) FROM history
    UNION ALL SELECT 'short_key', 1, count(*) FROM history UNION ALL SELECT 'good', 0, count(*) FROM history""")
def key_strength(t):
    """Weak keys are refused before any row is read; the good one tokenises the whole history."""
    user = F.col("user_id")
    cases = {
        "short_salt": lambda: TK.salted_token(user, SALT[:31]), "odd_bits": lambda: TK.salted_token(user, SALT, 130),
        "short_key": lambda: TK.hmac_token(user, KEY[:63]), "good": lambda: TK.hmac_token(user, KEY),
    }
    out = []
    for name, make in cases.items():
        try:
            measure, refused = F.count(make()), 0
        except ValueError:
            measure, refused = n_rows(), 1
        out.append(t.history.agg(F.lit(name).alias("case_name"), F.lit(refused).alias("refused"), measure.alias("n")))
    return Q.union(*out)


@query("pv5_exclude_private", "SELECT event_id FROM raw_listens WHERE NOT (truncated OR drift OR no_track OR private_flag)")
def exclude_private(t):
    return CT.parse(raw_json(t), CT.LISTENS).where(F.col("category") == "aplati").select("event_id")


@query("pv6_key_scan", """
    SELECT CAST(date AS STRING) AS date, count(*) AS n, count(*) FILTER (has_ip OR has_new) AS touched,
           count(*) FILTER (has_ip) AS ip_addr, count(*) FILTER (has_new) AS new_key FROM raw_listens GROUP BY date""")
def key_scan(t):
    return PV.key_scan(raw_json(t), ["ip_addr", "new_key"]).withColumn("date", F.col("date").cast("string"))


@query("pv7_purge", """
    SELECT CAST(date AS STRING) AS date, count(*) AS n, count(*) FILTER (has_ip) AS purged, 0 AS remaining FROM raw_listens
    WHERE date IN (SELECT date FROM raw_listens WHERE has_ip) GROUP BY date""")
def purge(t):
    """Rewrite only the affected days, then read them back: same line counts, no key left."""
    path = work_folder(t.spark, "pv7")
    lines = raw_json(t).select("date", "value")
    days = PV.affected_days(lines, ["ip_addr"])
    # One row per affected day: the calendar bounds the broadcast.
    cleaned = PV.purge_keys(lines.join(F.broadcast(days), "date", "left_semi"), ["ip_addr"])
    cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy(F.col("date").cast("string").alias("date")).agg(
        n_rows().alias("n"), F.sum("purged").alias("purged"), F.count_if(F.col("value").contains('"ip_addr"')).alias("remaining"),
    )


@query("pv8_k_anonymity", """
    SELECT k, count(*) AS groups, count(*) FILTER (listeners >= k) AS kept_groups, CAST(sum(listens) AS BIGINT) AS listens,
           CAST(COALESCE(sum(listens) FILTER (listeners >= k), 0) AS BIGINT) AS kept_listens
    FROM (SELECT date, msid, count(*) AS listens, count(DISTINCT user_tok) AS listeners FROM listens_flat GROUP BY 1, 2) AS x, (VALUES (2), (3), (5)) AS v(k) GROUP BY k""")
def k_anonymity(t):
    return PV.k_measure(A.day_facts(t.listens_flat), "listeners", "listens", [2, 3, 5])


@query("pv9_same_salt", """
    SELECT count(DISTINCT user_tok) AS left_tokens, 0 AS not_hex,
           count(DISTINCT user_tok) FILTER (user_tok IN (SELECT user_tok FROM full_load)) AS common FROM dumps""")
def same_salt(t):
    return R.same_salt(t.dumps, t.full_load, "user_tok")


@query("pv10_output_without_tokens", """
    SELECT 'present' AS status, 'listeners' AS column_name, count(*) AS filled FROM (SELECT DISTINCT date, msid FROM listens_flat) AS x UNION ALL
    SELECT 'present', 'listens', count(*) FROM (SELECT DISTINCT date, msid FROM listens_flat) AS x UNION ALL
    SELECT 'present', 'date', count(*) FROM (SELECT DISTINCT date, msid FROM listens_flat) AS x UNION ALL
    SELECT 'present', 'msid', count(*) FROM (SELECT DISTINCT date, msid FROM listens_flat) AS x UNION ALL
    SELECT 'present', 'mois', count(*) FROM (SELECT DISTINCT date, msid FROM listens_flat) AS x""")
def output_without_tokens(t):
    """The written facts hold no listener column."""
    path = work_folder(t.spark, "pv10")
    write_rebalanced(A.day_facts(t.listens_flat), path, ["mois"])
    return P.column_check(t.spark.read.parquet(path), ["date", "msid", "listens", "listeners", "mois"], forbidden=["user_id", "user_tok"])


@query("pv11_access_and_erasure", """
    WITH s AS (SELECT md5('u3') AS tok), d AS (SELECT DISTINCT date FROM listens_flat, s WHERE user_tok = tok)
    SELECT count(*) FILTER (user_tok = tok) AS subject_rows, count(*) FILTER (date IN (SELECT date FROM d) AND user_tok <> tok) AS rewritten,
           (SELECT count(*) FROM d) AS partitions FROM listens_flat, s""")
def access_and_erasure(t):
    """Rows of a subject, and the affected day partitions after erasure."""
    subject = F.md5(F.lit("u3"))
    listens = t.listens_flat
    mine = PV.subject_rows(listens, "user_tok", subject).agg(n_rows().alias("subject_rows"), F.count_distinct("date").alias("partitions"))
    kept = PV.erase_subject(listens, "user_tok", subject, "date").agg(n_rows()).scalar()
    return mine.withColumn("rewritten", kept)


@query("pv12_retention", """
    SELECT CAST(date AS STRING) AS date, count(*) AS n, count(*) AS in_files FROM listens WHERE date >= DATE '2024-01-16' GROUP BY date""")
def retention(t):
    """A dated table after retention: rows in the catalog's partitions, and rows in the files whatever the catalog says."""
    path = work_folder(t.spark, "pv12")
    dated = t.listens.select("event_id", F.col("date").cast("string").alias("day"))
    write_rebalanced(dated, path, ["day"])
    name = register(t.spark, f"pv12_{uuid.uuid4().hex}", path, "Raw zone by day", {}, ["day"])
    drop_partitions_before(t.spark, name, "day", "2024-01-16")
    t.spark.sql(f"MSCK REPAIR TABLE {name}")  # brings nothing back
    files = read_partitioned(t.spark, path).groupBy("day").agg(n_rows().alias("in_files"))
    listed = t.spark.table(name).groupBy("day").agg(n_rows().alias("n"))
    return files.join(listed, "day", "full_outer").select(F.col("day").cast("string").alias("date"), "n", "in_files")
