"""Incremental batches, late data and streaming."""

from pyspark.sql import functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import digest_tree as DT
from trackmetrics.operators import facts as A
from trackmetrics.operators import incremental as I
from trackmetrics.operators import loading as LD
from trackmetrics.operators import quality as Q
from trackmetrics.operators import resolve as R
from trackmetrics.plans.contracts import TOLERANT
from trackmetrics.plans.registry import query
from trackmetrics.session import materialise, work_folder
from trackmetrics.sources.layout import read_partitioned, write_planned, write_rebalanced
from trackmetrics.sources.views import loadable_json, raw_json
from trackmetrics.streaming import daily as ST


def batch_lines(t):
    """Raw lines of a batch that the contract accepts with its rejects and tolerated drift, and how many they are."""
    lines = materialise(loadable_json(t), "batch-lines")
    return lines, lines.count()


def minimised_lines(t):
    """As :func:`batch_lines`, with the lines that hold forbidden or new keys too: those are minimised, so the contract accepts them."""
    whole = t.raw_listens.where("NOT no_track").select("event_id", (F.col("has_ip") | F.col("has_new")).alias("__foreign"))
    raw = raw_json(t).join(whole, "event_id").drop("event_id")
    # A line cut short cannot be minimised; it stays as it came and is rejected by the load.
    clean = CT.minimise(raw.where("__foreign").withColumn("__line", F.col("value")), CT.LISTENS)
    clean = clean.withColumn("value", F.coalesce("value", "__line")).drop("__line")
    lines = materialise(raw.where("NOT __foreign").unionByName(clean).drop("__foreign"), "minimised-lines")
    return lines, lines.count()


@query("st1_incremental_load", """
    WITH c AS (SELECT DISTINCT user_tok, ts_s, msid, date, mois FROM raw_listens WHERE NOT (truncated OR drift OR no_track OR private_flag))
    SELECT mois, CASE WHEN DATE '2024-02-14' - date <= 30 THEN CAST(date AS STRING) ELSE '_ancien' END AS jour, '2700' AS dump, count(*) AS n FROM c GROUP BY ALL""")
def incremental_load(t):
    """Load a batch twice: the second load replaces the partitions of the first."""
    lines, expected = minimised_lines(t)
    target, rejected = work_folder(t.spark, "st1"), work_folder(t.spark, "st1-rejects")
    for _ in range(2):
        LD.load_batch(lines, TOLERANT, "2700", "2024-02-14", target, rejected, expected)
    return read_partitioned(t.spark, target).groupBy("mois", "jour", "dump").agg(n_rows().alias("n"))


_JOUR = "CASE WHEN reception - date <= 30 THEN CAST(date AS STRING) ELSE '_ancien' END"


@query("st2_late_routing", f"SELECT mois, {_JOUR} AS jour, count(*) AS n FROM dumps GROUP BY 1, 2")
def late_routing(t):
    return I.route_late(t.dumps, "reception", "date").groupBy("mois", "jour").agg(n_rows().alias("n"))


@query("st3_routing_check", "SELECT count(*) AS n, 0 AS recent_in_old, 0 AS old_in_recent, 0 AS wrong_day FROM dumps")
def routing_check(t):
    """Routing is checked on what was written."""
    path = work_folder(t.spark, "st3")
    routed = I.route_late(t.dumps, "reception", "date")
    write_planned(routed, path, ["mois", "jour"], ["user_tok", "ts_s"], 134.7)
    return I.routing_errors(read_partitioned(t.spark, path), "reception", "date")


@query("st4_batch_dedup", """
    SELECT CAST(reception AS STRING) AS reception, count(*) AS n_read, count(DISTINCT (user_tok, ts_s, msid)) AS n_kept FROM dumps GROUP BY 1""")
def batch_dedup(t):
    per_key = t.dumps.groupBy("reception", "user_tok", "ts_s", "msid").agg(n_rows().alias("n"))
    return per_key.groupBy(F.col("reception").cast("string").alias("reception")).agg(F.sum("n").alias("n_read"), n_rows().alias("n_kept"))


@query("st5_rebuilt_facts", """
    WITH i AS (SELECT DISTINCT user_tok, ts_s, msid, date FROM dumps),
         k AS (SELECT * FROM i WHERE (user_tok, ts_s, msid) NOT IN (SELECT (user_tok, ts_s, msid) FROM full_load))
    SELECT CAST(date AS STRING) AS date, msid, count(*) AS listens, count(DISTINCT user_tok) AS listeners FROM k GROUP BY 1, 2""")
def rebuilt_facts(t):
    fresh = I.without_full_load(t.dumps, t.full_load)
    return A.day_facts(fresh, unique=True).select(F.col("date").cast("string").alias("date"), "msid", "listens", "listeners")


@query("st6_lateness_profile", """
    SELECT count(*) AS n, quantile_disc(reception - date, 0.5) AS p50, quantile_disc(reception - date, 0.9) AS p90,
           quantile_disc(reception - date, 0.99) AS p99 FROM dumps""")
def lateness_profile(t):
    return I.lateness_profile(t.dumps, "reception", "date")


@query("st7_continuity", """
    WITH b AS (SELECT no, start_s, end_s, lag(end_s) OVER (ORDER BY no) AS p, lead(start_s) OVER (ORDER BY no) AS q FROM bounds)
    SELECT no, CASE WHEN end_s < q THEN 'TROU' WHEN end_s > q THEN 'CHEVAUCHEMENT' WHEN p IS NULL THEN 'PREMIER' WHEN start_s = p THEN 'SUITE'
                    WHEN start_s > p THEN 'TROU' ELSE 'CHEVAUCHEMENT' END AS verdict FROM b""")
def continuity(t):
    return I.continuity(t.bounds.select("no", "start_s", "end_s")).select("no", "verdict")


@query("st7_candidates_against_ledger", """
    WITH l AS (SELECT no, start_s, end_s FROM bounds WHERE day < DATE '1999-01-01' AND n % 3 <> 0), c AS (SELECT no, start_s, end_s FROM bounds)
    SELECT c.no, CASE WHEN c.no IN (SELECT no FROM l) THEN 'RECHARGEMENT'
        WHEN c.end_s < (SELECT start_s FROM l WHERE l.no > c.no ORDER BY l.no LIMIT 1) THEN 'TROU'
        WHEN c.end_s > (SELECT start_s FROM l WHERE l.no > c.no ORDER BY l.no LIMIT 1) THEN 'CHEVAUCHEMENT'
        WHEN NOT EXISTS (SELECT 1 FROM l WHERE l.no < c.no) THEN 'PREMIER'
        WHEN c.start_s = (SELECT end_s FROM l WHERE l.no < c.no ORDER BY l.no DESC LIMIT 1) THEN 'SUITE'
        WHEN c.start_s > (SELECT end_s FROM l WHERE l.no < c.no ORDER BY l.no DESC LIMIT 1) THEN 'TROU' ELSE 'CHEVAUCHEMENT' END AS verdict FROM c""")
def candidates_against_ledger(t):
    """Every published batch judged against a ledger that lacks some."""
    ledger = t.bounds.where("day < DATE '1999-01-01' AND n % 3 <> 0")
    return I.candidate_continuity(t.bounds, ledger)


@query("st8_load_plan", "SELECT no, CAST(day AS STRING) AS day FROM bounds WHERE no > (SELECT max(no) FROM bounds WHERE day < DATE '2001-05-01')")
def load_plan(t):
    loaded = t.bounds.where("day < DATE '2001-05-01'")
    return I.pending(t.bounds, loaded).select("no", F.col("day").cast("string").alias("day"))


@query("st9_ledger", """
    WITH c AS (SELECT count(*) AS announced, count(DISTINCT (user_tok, ts_s, msid)) FILTER (NOT (private_flag OR truncated OR drift)) AS kept
               FROM raw_listens WHERE NOT (has_ip OR has_new OR no_track))
    SELECT 2700 AS no, announced, kept AS n_rows, kept AS recent, 0 AS old, 'PREMIER' AS verdict FROM c""")
def ledger(t):
    """A ledger row appears only after a load whose counts agree; a refused load leaves none."""
    lines, expected = batch_lines(t)
    target, rejected, path = (work_folder(t.spark, n) for n in ("st9", "st9-rejects", "st9-ledger"))
    good = LD.load_batch(lines, TOLERANT, "2700", "2024-01-31", target, rejected, expected)
    LD.register_batch(t.spark, path, 2700, (1704067200, 1706659200), good, target, 1706700000, "PREMIER")
    bad = LD.load_batch(lines, TOLERANT, "2701", "2024-01-31", target, rejected, expected + 1)
    try:
        LD.register_batch(t.spark, path, 2701, (1706659200, 1706745600), bad, target, 1706790000, "SUITE")
    except ValueError:
        pass  # refused: no ledger row
    return t.spark.read.parquet(path).select("no", "announced", "n_rows", "recent", "old", "verdict")


def freshness_ledger(t):
    """One ledger row per batch: registered two hours after its end, later when its volume is odd."""
    per = t.bounds.withColumn("registered_s", F.col("end_s") + 7200 + (F.col("n") % 5) * 43200 - F.when(F.col("n") % 11 == 0, 7200 + (F.col("n") % 5) * 43200).otherwise(0))
    recent = F.floor(F.col("n") * 0.9).cast("long")
    old = F.col("n") - recent + F.when(F.col("n") % 13 == 0, 1).otherwise(0)
    return per.select("no", "end_s", "registered_s", F.col("n").alias("n_rows"), recent.alias("recent"), old.alias("old"))


@query("st10_freshness", """
    SELECT no, CASE WHEN n % 11 = 0 THEN 0 ELSE 7200 + (n % 5) * 43200 END AS freshness_s, round(100.0 * (n * 9 // 10) / n, 4)::DOUBLE AS recent_pct, n AS n_rows,
           CASE WHEN n % 13 = 0 THEN 'row counts differ' WHEN n % 11 = 0 THEN 'registered before its end' END AS error FROM bounds""")
def freshness(t):
    return I.freshness(freshness_ledger(t))


@query("st11_alerts", """
    WITH b AS (SELECT *, CASE WHEN n % 11 = 0 THEN 0 ELSE 7200 + (n % 5) * 43200 END AS late, n % 11 <> 0 AS ok FROM bounds)
    SELECT 'load_failed' AS rule, CASE WHEN count(*) FILTER (NOT ok) > 0 THEN 1 ELSE 0 END AS raised FROM b UNION ALL
    SELECT 'no_load_24h', CASE WHEN (SELECT max(end_s) FROM bounds) + 90000 - max(end_s + late) FILTER (ok) > 86400 THEN 1 ELSE 0 END FROM b UNION ALL
    SELECT 'stale_36h', CASE WHEN count(*) FILTER (ok AND late > 129600) > 0 THEN 1 ELSE 0 END FROM b""")
def alerts(t):
    runs = freshness_ledger(t).withColumn("ok", F.col("n_rows") % 11 != 0)
    return I.alerts(runs, t.bounds.agg(F.max("end_s") + 90000).scalar())


def streamed(t):
    """Folders of the events and the daily counts after the stream has read all files."""
    store, counts, checkpoint = (work_folder(t.spark, f"st12-{n}") for n in ("store", "counts", "state"))
    ST.start_events(ST.event_stream(t.spark, t.folder, "events.parquet"), store, counts, checkpoint).awaitTermination()
    return store, counts


@query("st12_daily_stream", """
    SELECT CAST(date AS STRING) AS date, msid, count(DISTINCT (user_tok, ts_us)) AS listens FROM (
        SELECT date, msid, user_tok, epoch_us(ts) AS ts_us FROM listens_flat JOIN events USING (event_id)) AS x GROUP BY 1, 2""")
def daily_stream(t):
    """Counts of all days, open ones included."""
    return ST.daily_counts(t.spark, streamed(t)[1]).select(F.col("date").cast("string").alias("date"), "msid", "listens")


@query("st12_stream_partitions", """
    WITH e AS (SELECT DISTINCT mois, date, user_tok, msid, epoch_us(ts) AS ts_us FROM listens_flat JOIN events USING (event_id))
    SELECT mois, CASE WHEN (SELECT max(date) FROM e) - date <= 30 THEN CAST(date AS STRING) ELSE '_ancien' END AS jour, count(*) AS n FROM e GROUP BY 1, 2""")
def stream_partitions(t):
    """Events as stored: every one once, late ones under the partition of old events."""
    return read_partitioned(t.spark, streamed(t)[0]).groupBy("mois", "jour").agg(n_rows().alias("n"))


def merge_inputs(t):
    """Facts, stored once, and a damaged copy: one month deleted, one month with false counts."""
    facts = materialise(t.day_facts.select("date", "msid", "listens", "listeners", "mois"), "merge-facts")
    damaged = facts.where("mois <> '2001-08'").withColumn("listens", F.when(F.col("mois") == "2001-07", F.col("listens") + 1).otherwise(F.col("listens")))
    return facts, damaged


@query("st13_merge", """
    SELECT CAST(date AS STRING) AS date, msid, listens, listeners FROM day_facts""")
def merge(t):
    """Upsert of the true facts into the damaged ones, only the touched months rewritten."""
    facts, damaged = merge_inputs(t)
    path = work_folder(t.spark, "st13")
    write_rebalanced(damaged, path, ["mois"])
    I.upsert(path, facts, ["date", "msid"], ["listens", "listeners"])
    return read_partitioned(t.spark, path).select(F.col("date").cast("string").alias("date"), "msid", "listens", "listeners")


@query("st14_merge_proof", """
    WITH f AS (SELECT count(*) AS n FROM day_facts), d AS (SELECT count(*) AS n FROM day_facts WHERE mois <> '2001-08')
    SELECT 'initial' AS state, n, 1 AS as_initial, NULL AS pending FROM f UNION ALL SELECT 'damaged', n, 0, (SELECT count(*) FROM day_facts WHERE mois IN ('2001-07', '2001-08')) FROM d
    UNION ALL SELECT 'merged', n, 1, 0 FROM f UNION ALL SELECT 'merged_again', n, 1, 0 FROM f""")
def merge_proof(t):
    """Fingerprints before, after damage, after a merge and after a second merge."""
    facts, damaged = merge_inputs(t)
    keys, values = ["date", "msid"], ["listens", "listeners"]
    facts, damaged = facts.select(*keys, *values), damaged.select(*keys, *values)

    def upserted(stored, name):  # stored, as three reads follow
        return materialise(I.merge_groups(stored, I.differing_groups(stored, facts, keys, values).drop("kind"), keys, values), name)

    merged = upserted(damaged, "st14-merged")
    again = upserted(merged, "st14-again")
    print_of = lambda df: I.fingerprint(df, keys + values)
    initial = print_of(facts).select("digest").scalar()
    parts = []
    for state, df in (("initial", facts), ("damaged", damaged), ("merged", merged), ("merged_again", again)):
        pending = F.lit(None).cast("long") if state == "initial" else I.differing_groups(df, facts, keys, values).agg(n_rows()).scalar()
        parts.append(print_of(df).select(F.lit(state).alias("state"), "n", (F.col("digest") == initial).cast("int").alias("as_initial"), pending.alias("pending")))
    return Q.union(*parts)


#: The first days with facts from these on are damaged: recounted, one title gone, gone as a whole, one title new.
_DAMAGED = ("2000-03-14", "2000-05-20", "2000-08-03", "2001-05-01")


def falsified(t):
    """Facts, and a damaged copy."""
    facts = t.day_facts.select("date", "msid", "listens", "listeners", "mois")
    day = F.col("date").cast("string")
    recounted, thinned, gone, grown = facts.agg(*[F.min(F.when(day >= d, day)) for d in _DAMAGED]).first()
    lowest = facts.where(day == F.lit(thinned)).agg(F.min("msid")).scalar()
    copy = facts.withColumn("listens", F.when(day.eqNullSafe(F.lit(recounted)), F.col("listens") + 1).otherwise(F.col("listens")))
    copy = copy.where(~(day.eqNullSafe(F.lit(thinned)) & (F.col("msid") == lowest)) & ~day.eqNullSafe(F.lit(gone)))
    extra = facts.where(day == F.lit(grown)).agg(F.min("date").alias("date")).where("date IS NOT NULL").select(
        "date", F.lit("new").alias("msid"), F.lit(1).cast("long").alias("listens"), F.lit(1).cast("long").alias("listeners"), X.month_of(F.col("date")).alias("mois"))
    return facts, copy.unionByName(extra)


_FALSE = f"""
    WITH f AS (SELECT CAST(date AS STRING) AS date, msid, listens, listeners FROM day_facts),
         d AS (SELECT {", ".join(f"min(date) FILTER (date >= '{d}') AS d{k}" for k, d in enumerate(_DAMAGED))} FROM f),
         g AS (SELECT date, msid, listens + CASE WHEN date = d0 THEN 1 ELSE 0 END AS listens, listeners FROM f, d
               WHERE NOT (date = d1 AND msid = (SELECT min(msid) FROM f, d WHERE date = d1)) AND date <> d2
               UNION ALL SELECT d3, 'new', 1, 1 FROM d WHERE d3 IS NOT NULL),
         x AS (SELECT coalesce(f.date, g.date) AS date, coalesce(f.msid, g.msid) AS msid,
                      CASE WHEN g.date IS NULL THEN 'missing' WHEN f.date IS NULL THEN 'added' ELSE 'changed' END AS kind
               FROM f FULL JOIN g ON f.date = g.date AND f.msid = g.msid WHERE (f.listens, f.listeners) IS DISTINCT FROM (g.listens, g.listeners))"""


@query("st14_digest_tree", _FALSE + " SELECT date, msid, kind FROM x")
def digest_tree(t):
    """What differs between two tables, read from the days their digest trees point to."""
    facts, copy = (materialise(x, "st14-tree") for x in falsified(t))
    trees = [DT.digest_tree(x, "msid", ["listens", "listeners"]) for x in (facts, copy)]
    return DT.changed_rows(facts, copy, DT.differing(*trees, level=2), "msid", ["listens", "listeners"])


@query("st14_rows_read", _FALSE + """
    SELECT (SELECT count(DISTINCT date) FROM x) AS days, (SELECT count(*) FROM f WHERE date IN (SELECT date FROM x)) AS left_rows,
           (SELECT count(*) FROM g WHERE date IN (SELECT date FROM x)) AS right_rows""")
def rows_read(t):
    """Days that differ and the rows that have to be read for them."""
    trees = [DT.digest_tree(x, "msid", ["listens", "listeners"]) for x in falsified(t)]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return DT.differing(*trees, level=2).agg(n_rows().alias("days"), total("left_n").alias("left_rows"), total("right_n").alias("right_rows"))


@query("st15_batch_manifest", """
    SELECT mois, count(*) AS n, count(DISTINCT date) AS days, CAST(min(date) AS STRING) AS first_day, CAST(max(date) AS STRING) AS last_day FROM plays GROUP BY mois""")
def batch_manifest(t):
    return I.batch_statistics(t.plays, "date", "mois")


@query("st16_full_overlap", """
    WITH i AS (SELECT user_tok, ts_s, msid, count(*) AS n, count(DISTINCT reception) AS b FROM dumps GROUP BY 1, 2, 3),
         a AS (SELECT DISTINCT ts_s, msid, user_tok FROM dumps WHERE reception - date > 30)
    SELECT (SELECT count(*) FROM i WHERE n > 1) AS repeated, (SELECT CAST(sum(n - 1) AS BIGINT) FROM i) AS excess, (SELECT count(*) FROM a) AS triples,
           (SELECT count(*) FROM a WHERE (user_tok, ts_s, msid) IN (SELECT (user_tok, ts_s, msid) FROM full_load)) AS triples_found,
           (SELECT count(*) FROM (SELECT DISTINCT ts_s, msid FROM a) AS x WHERE (ts_s, msid) IN (SELECT (ts_s, msid) FROM full_load)) AS pairs_found""")
def full_overlap(t):
    """Repeated triples between batches, and how many old rows the full load already holds."""
    q1 = I.duplicate_anatomy(t.dumps, list(I.EVENT_KEY), "reception").agg(F.struct(F.max("groups").alias("g"), F.max("excess").alias("e"))).scalar()
    old = t.dumps.where(I.lateness("reception", "date") > I.LATE_DAYS)
    q2 = R.witness_overlap(old, t.full_load, ["ts_s", "msid"], "user_tok")
    return q2.select(q1.getField("g").alias("repeated"), q1.getField("e").alias("excess"), "triples", "triples_found", "pairs_found")


@query("st17_volume_series", """
    SELECT 'month' AS series, substr(CAST(day AS STRING), 1, 7) AS lot, CAST(sum(n) AS BIGINT) AS n FROM bounds GROUP BY 2 UNION ALL
    SELECT 'day', CAST(day AS STRING), CAST(sum(n) AS BIGINT) FROM bounds GROUP BY 2""")
def volume_series(t):
    """Volume series per month and per publication day, from the batch bounds."""
    lots = F.array(
        F.struct(F.lit("month").alias("series"), X.month_of(F.col("day")).alias("lot")),
        F.struct(F.lit("day").alias("series"), F.col("day").cast("string").alias("lot")),
    )
    return t.bounds.select(F.inline(lots), "n").groupBy("series", "lot").agg(F.sum("n").alias("n"))
