"""Business queries of the star schema, plan evidence and load controls."""

from pyspark.sql import functions as F

from trackmetrics.functions.counting import n_distinct, n_rows
from trackmetrics.operators import profiling as P
from trackmetrics.operators import warehouse as W
from trackmetrics.plans.registry import query
from trackmetrics.session import shuffle_width, work_folder
from trackmetrics.sources import clustering as C
from trackmetrics.sources import layout as L
from trackmetrics.sources.tables import register, unique_name

_QA = """
    SELECT track_id, CAST(sum(playcount) AS BIGINT) AS plays, count(DISTINCT user_id) AS listeners FROM {h} GROUP BY track_id ORDER BY plays DESC, track_id LIMIT 10"""
_QB = """
    SELECT genre, count(*) AS n_rows, CAST(sum(playcount) AS BIGINT) AS plays FROM {h} h JOIN catalog c ON h.track_id = c.track_id
    WHERE genre IS NOT NULL GROUP BY genre ORDER BY plays DESC, genre LIMIT 10"""
_QC = """
    SELECT count(*) AS n_rows, CAST(sum(playcount) AS BIGINT) AS plays FROM {h} WHERE track_id >= 20 AND track_id < 120"""
_COPIES = """
    WITH r AS (SELECT CASE WHEN c = 0 THEN CAST(user_id AS STRING) ELSE sha1(concat(CAST(user_id AS STRING), '#', CAST(c AS STRING))) END AS user_id, track_id, playcount
               FROM history, range(0, {factor}) x(c))"""


def top_tracks(history, part=()):
    found = W.engagement(history, part=part).select("track_id", F.col("total_plays").alias("plays"), F.col("unique_listeners").alias("listeners"))
    return found.orderBy(F.desc("plays"), "track_id").limit(10)


def top_genres(history, catalog):
    found = W.by_attribute(history, catalog, "track_id", "genre", {"n_rows": n_rows(), "plays": F.sum("playcount")})
    return found.orderBy(F.desc("plays"), "genre").limit(10)


def key_range(history):
    picked = history.where((F.col("track_id") >= 20) & (F.col("track_id") < 120))
    return picked.agg(n_rows().alias("n_rows"), F.sum("playcount").alias("plays"))


@query("qa_top_tracks", _QA.format(h="history"))
def qa(t):
    return top_tracks(t.history)


@query("qb_top_genres", _QB.format(h="history"))
def qb(t):
    return top_genres(t.history, t.catalog)


@query("qc_key_range", _QC.format(h="history"))
def qc(t):
    return key_range(t.history)


def written_facts(t, name: str, bucketed: bool = False):
    """Facts written by month, sorted by day inside a file."""
    path = work_folder(t.spark, name)
    facts = t.day_facts
    (facts.hint("rebalance", F.col("mois")).sortWithinPartitions("mois", "date").write.partitionBy("mois").parquet(path))
    return path


@query("qd_physical_footprint")
def physical_footprint(t):
    """Files, bytes and rows per month of a written table, the share of rows out of order, and the skew of its key."""
    path = written_facts(t, "qd")
    table = L.read_partitioned(t.spark, path)
    skew = P.key_skew(table, "msid").select("factor").scalar()
    month = r"mois=([^/]+)"
    order = C.unsorted_share(C.file_ranges(table, ["date"]), "date", F.regexp_extract("file", month, 1))
    return L.file_report(table, month).join(order, "part").withColumn("key_skew", skew)


@query("qe_plan_evidence")
def plan_evidence(t):
    """Bucketed facts and dimension: the join and the aggregate run without an exchange on the key."""
    # The bucketed tables live in this session's warehouse: external location in the shared folder.
    names = [unique_name("qe_fact"), unique_name("qe_dim")]
    for name, df in zip(names, (t.history, t.catalog.select("track_id", "genre"))):
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (df.write.mode("overwrite").option("path", work_folder(t.spark, name)).bucketBy(8, "track_id").sortBy("track_id").saveAsTable(name))
    fact, dim = map(t.spark.table, names)
    plans = {
        "aggregate_on_bucket_key": fact.groupBy("track_id").agg(F.sum("playcount").alias("plays")),
        "merge_join_on_bucket_key": fact.hint("merge").join(dim, "track_id"),
        "star_join_left_to_the_optimizer": fact.join(dim, "track_id"),
    }
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    rows = [(name, text(df).count("Exchange hashpartitioning")) for name, df in plans.items()]
    total = plans["aggregate_on_bucket_key"].agg(F.sum("plays")).scalar()
    return t.spark.createDataFrame(rows, "check string, key_exchanges int").withColumn("plays", total)


@query("qf_title_totals", """
    SELECT msid, CAST(sum(listens) AS BIGINT) AS listens, CAST(sum(listeners) AS BIGINT) AS day_listeners FROM day_facts GROUP BY msid ORDER BY listens DESC, msid LIMIT 10""")
def title_totals(t):
    totals = t.day_facts.groupBy("msid").agg(F.sum("listens").alias("listens"), F.sum("listeners").alias("day_listeners"))
    return totals.orderBy(F.desc("listens"), "msid").limit(10)


@query("qg_year_weekday", """
    SELECT year(date) AS year, isodow(date) AS weekday, CAST(sum(listens) AS BIGINT) AS listens FROM day_facts GROUP BY 1, 2""")
def year_weekday(t):
    """Star join with the calendar; facts are summed per day first, so the join sees one row per day."""
    per_day = t.day_facts.groupBy("date").agg(F.sum("listens").alias("listens"))
    span = per_day.agg(F.struct(F.min("date").alias("a"), F.max("date").alias("b"))).scalar()
    days = W.calendar(t.spark, span.getField("a"), span.getField("b"))
    return per_day.join(days, "date").groupBy("year", "weekday").agg(F.sum("listens").alias("listens"))


@query("qh_one_month", """
    SELECT count(*) AS groups, CAST(sum(listens) AS BIGINT) AS listens FROM day_facts WHERE date >= DATE '1996-06-01' AND date < DATE '1996-07-01'""")
def one_month(t):
    return W.date_range(t.day_facts, "1996-06-01", "1996-07-01").agg(n_rows().alias("groups"), F.sum("listens").alias("listens"))


@query("qi_recent_titles", """
    SELECT msid, CAST(sum(listens) AS BIGINT) AS listens FROM day_facts WHERE date >= DATE '2001-07-03' GROUP BY msid ORDER BY listens DESC, msid LIMIT 10""")
def recent_titles(t):
    return W.recent_top(t.day_facts, F.lit("2001-07-03").cast("date"), 10)


@query("qj_pruned_external", """
    SELECT 'with_predicate' AS scan, count(*) AS groups, CAST(sum(listens) AS BIGINT) AS listens, 1 AS prunes FROM day_facts WHERE date >= DATE '1996-06-01' AND date < DATE '1996-07-01'
    UNION ALL SELECT 'without_predicate', count(*), CAST(sum(listens) AS BIGINT), 0 FROM day_facts WHERE date >= DATE '1996-06-01' AND date < DATE '1996-07-01'""")
def pruned_external(t):
    """The same month of an external table with and without the partition predicate."""
    name = register(t.spark, unique_name("qj_facts"), written_facts(t, "qj"), "Facts by month", {"usage": "test"}, ["mois"])
    table = t.spark.table(name)
    day = F.col("date")
    plain = table.where((day >= F.lit("1996-06-01").cast("date")) & (day < F.lit("1996-07-01").cast("date")))
    out = []
    for scan, df in (("with_predicate", W.date_range(table, "1996-06-01", "1996-07-01")), ("without_predicate", plain)):
        prunes = "PartitionFilters: [isnotnull(mois" in df._jdf.queryExecution().executedPlan().toString()
        out.append(df.agg(F.lit(scan).alias("scan"), n_rows().alias("groups"), F.sum("listens").alias("listens"), F.lit(int(prunes)).alias("prunes")))
    return out[0].unionByName(out[1])


@query("qk_artist_control", """
    WITH e AS (SELECT quantile_disc(total_plays, 0.75) AS p FROM engagement JOIN catalog USING (track_id)),
         x AS (SELECT artist, total_plays, genre, CASE WHEN total_plays >= p THEN 1 ELSE 0 END AS hit FROM catalog JOIN engagement USING (track_id), e),
         a AS (SELECT artist, count(*) AS n, sum(total_plays) AS plays, sum(hit) AS hits, count(genre) AS g FROM x GROUP BY artist)
    SELECT count(*) AS artists, CAST(sum(n) AS BIGINT) AS titles, CAST(sum(plays) AS BIGINT) AS plays, CAST(sum(hits) AS BIGINT) AS hits,
           round(100.0 * sum(hits) / sum(n), 2)::DOUBLE AS hit_pct, count(*) FILTER (g = 0) AS without_genre, max(n) AS most_titles FROM a""")
def artist_control(t):
    return W.artist_reference(t.catalog, t.history).agg(
        n_rows().alias("artists"), F.sum("titles").alias("titles"), F.sum("plays").alias("plays"), F.sum("hits").alias("hits"),
        F.round(F.lit(100.0) * F.sum("hits") / F.sum("titles"), 2).alias("hit_pct"),
        F.count_if(F.col("main_genre").isNull()).alias("without_genre"), F.max("titles").alias("most_titles"),
    )


@query("ql_load_volumetry", """
    SELECT 'dim_track' AS loaded, count(*) AS n, NULL AS listens FROM catalog UNION ALL SELECT 'fact_listening', count(*), CAST(sum(playcount) AS BIGINT) FROM history
    UNION ALL SELECT 'fait_jour', count(*), CAST(sum(listens) AS BIGINT) FROM day_facts""")
def load_volumetry(t):
    none = F.lit(None).cast("long")
    parts = (("dim_track", t.catalog, none), ("fact_listening", t.history, F.sum("playcount")), ("fait_jour", t.day_facts, F.sum("listens")))
    frames = [df.agg(F.lit(name).alias("loaded"), n_rows().alias("n"), F.max(m).alias("listens") if m is none else m.alias("listens")) for name, df, m in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("ql_load_integrity", """
    SELECT count(DISTINCT track_id) AS tracks, count(DISTINCT user_id) AS listeners, min(playcount) AS lowest, max(playcount) AS highest FROM history""")
def load_integrity(t):
    ends = t.history.agg(F.min("playcount").alias("lowest"), F.max("playcount").alias("highest"))
    return ends.select(n_distinct(t.history, "track_id").alias("tracks"), n_distinct(t.history, "user_id").alias("listeners"), "lowest", "highest")


def copies(t, factor: int, history=None):
    source = t.history if history is None else history
    return W.replicate(source.withColumn("user_id", F.col("user_id").cast("string")), "user_id", factor)


@query("qm_top_tracks_x10", _COPIES.format(factor=10) + _QA.format(h="r"))
def qm_top_tracks(t):
    """The rows meet by track and part of the users before they are copied, so no copy is shuffled; parts keep a hot track in many tasks."""
    parted = t.history.withColumn("__part", F.pmod(F.xxhash64("user_id"), F.lit(64)).cast("int"))
    return top_tracks(copies(t, 10, parted.repartition(shuffle_width(t.spark), "track_id", "__part")), ["__part"])


@query("qm_top_genres_x10", _COPIES.format(factor=10) + _QB.format(h="r"))
def qm_top_genres(t):
    return top_genres(copies(t, 10), t.catalog)


@query("qm_key_range_x50", _COPIES.format(factor=50) + _QC.format(h="r"))
def qm_key_range(t):
    return key_range(copies(t, 50))
