"""Joins, set operations and top-k."""

from pyspark.sql import functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import incremental as I
from trackmetrics.operators import profiling as P
from trackmetrics.operators import resolve as R
from trackmetrics.operators import sketches as SK
from trackmetrics.operators import warehouse as W
from trackmetrics.operators.bloom import may_hold
from trackmetrics.operators.skew import null_safe_join
from trackmetrics.plans.registry import query
from trackmetrics.session import materialise



@query("jn1_catalog_with_engagement", """
    SELECT c.track_id, artist, total_plays, unique_listeners FROM catalog c JOIN engagement e ON c.track_id = e.track_id""")
def catalog_with_engagement(t):
    # Both sides are one row per track, so the join key cannot be hot; Catalyst
    # broadcasts the smaller side when its statistics allow it.
    joined = t.catalog.join(W.engagement(t.history), "track_id")
    return joined.select("track_id", "artist", "total_plays", "unique_listeners")


@query("jn2_orphan_keys", """
    SELECT mbid, count(*) AS n_rows, min(ts_s) AS first_ts FROM listens_flat
    WHERE mbid IS NOT NULL AND mbid NOT IN (SELECT rec_id FROM canon) GROUP BY mbid""")
def orphan_keys(t):
    """Recording ids of the listens that are no canonical ids."""
    known = t.canon.select(F.col("rec_id").alias("mbid"))
    return R.orphans(t.listens_flat.where("mbid IS NOT NULL"), known, "mbid", {"n_rows": n_rows(), "first_ts": F.min("ts_s")})


@query("jn3_overlap_measure", """
    WITH i AS (SELECT user_tok, ts_s, msid, count(*) AS n FROM dumps GROUP BY 1, 2, 3)
    SELECT CAST(sum(n) AS BIGINT) AS batch_rows,
           CAST(sum(n) FILTER ((user_tok, ts_s, msid) IN (SELECT (user_tok, ts_s, msid) FROM full_load)) AS BIGINT) AS same_triple,
           CAST(sum(n) FILTER ((ts_s, msid) IN (SELECT (ts_s, msid) FROM full_load)) AS BIGINT) AS same_pair FROM i""")
def overlap_measure(t):
    return R.overlap(t.dumps, t.full_load, ["user_tok", "ts_s", "msid"], ["ts_s", "msid"])


@query("jn3_overlap_sketch", """
    SELECT mois, count(*) AS common, 1 AS within_5_pct FROM (SELECT DISTINCT mois, user_tok, ts_s, msid FROM dumps INTERSECT SELECT mois, user_tok, ts_s, msid FROM full_load) AS x GROUP BY mois""")
def overlap_sketch(t):
    """Triples of a month that both tables hold: exact, and from one stored sketch per month and table."""
    keys = ["user_tok", "ts_s", "msid"]
    sides = [materialise(SK.key_sketches(x, keys, ["mois"]), "jn3") for x in (t.dumps, t.full_load)]
    exact = t.dumps.select("mois", *keys).intersect(t.full_load.select("mois", *keys)).groupBy("mois").agg(n_rows().alias("common"))
    close = F.abs(F.col("estimate") - F.col("common")) <= 0.05 * F.col("common") + 1
    return exact.join(SK.overlap_estimates(*sides, ["mois"]), "mois", "left").select("mois", "common", F.coalesce(close, F.lit(False)).cast("int").alias("within_5_pct"))


@query("jn4_reconcile_counts", """
    WITH a AS (SELECT mois, count(*) AS n FROM plays GROUP BY mois),
         b AS (SELECT substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS mois, count(*) AS n FROM orders GROUP BY 1)
    SELECT COALESCE(a.mois, b.mois) AS mois, a.n AS found, b.n AS announced,
           CASE WHEN a.n IS NOT DISTINCT FROM b.n THEN 0 ELSE 1 END AS differs FROM a FULL JOIN b ON a.mois = b.mois""")
def reconcile_counts(t):
    found = t.plays.groupBy("mois").agg(n_rows().alias("found"))
    announced = t.orders.groupBy(X.month_of(F.col("o_orderdate")).alias("mois")).agg(n_rows().alias("announced"))
    return R.reconcile(found, announced, "mois", "found", "announced")


@query("jn5_populations", """
    WITH l AS (SELECT doc_id, quality FROM labels), p AS (SELECT doc_id, n_chars FROM documents)
    SELECT CASE WHEN l.doc_id IS NULL THEN 'right_only' WHEN p.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS population,
           count(*) AS n FROM l FULL JOIN p ON l.doc_id = p.doc_id GROUP BY 1""")
def populations(t):
    return R.populations(t.labels.select("doc_id"), t.documents.select("doc_id"), "doc_id")


@query("jn6_lookup_cascade", """
    WITH d AS (SELECT rec_id, rec_id AS target FROM canon UNION ALL
               SELECT rec_id, canon_id FROM redirect WHERE rec_id NOT IN (SELECT rec_id FROM canon)),
         u AS (SELECT lookup_key, min(rec_id) AS target FROM canon WHERE lookup_key IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
         c AS (SELECT msid, mbid, lastfm, CASE WHEN k % 11 = 0 THEN NULL
                 ELSE regexp_replace(lower(concat(artist_name, track_name)), '[^a-z0-9_]', '', 'g') END AS key FROM listens_flat)
    SELECT msid, COALESCE(a.target, b.target, u.target) AS rec_id,
           CASE WHEN a.target IS NOT NULL THEN CASE WHEN mbid IN (SELECT rec_id FROM canon) THEN 'mbid_direct' ELSE 'mbid_redirection' END
                WHEN b.target IS NOT NULL THEN 'lastfm' WHEN u.target IS NOT NULL THEN 'cle_artiste_titre' ELSE 'aucune' END AS method,
           count(*) AS listens
    FROM c LEFT JOIN d a ON c.mbid = a.rec_id LEFT JOIN d b ON c.lastfm = b.rec_id LEFT JOIN u ON c.key = u.lookup_key
    GROUP BY 1, 2, 3""")
def lookup_cascade(t):
    solved = R.resolve_stored(t.listens_flat, t.canon, t.redirect)
    return solved.groupBy("msid", "rec_id", "method").agg(F.sum("listens").alias("listens"))


@query("jn7_redirect_resolution", """
    SELECT rec_id, rec_id AS target, 'direct' AS route FROM canon UNION ALL
    SELECT rec_id, canon_id, 'redirection' FROM redirect WHERE rec_id NOT IN (SELECT rec_id FROM canon)""")
def redirect_resolution(t):
    return R.resolver(t.canon, t.redirect)


@query("jn8_attachment_route", """
    SELECT CASE WHEN mbid IN (SELECT rec_id FROM canon) THEN 'direct'
                WHEN mbid IN (SELECT rec_id FROM redirect) THEN 'redirection' ELSE 'hors_canonique' END AS route,
           count(*) AS n, count(DISTINCT mbid) AS ids FROM listens_flat WHERE mbid IS NOT NULL GROUP BY 1""")
def attachment_route(t):
    ids = t.listens_flat.where("mbid IS NOT NULL").groupBy("mbid").agg(n_rows().alias("n"))
    routed = R.attach_route(ids, "mbid", t.canon, t.redirect)
    return routed.groupBy("route").agg(F.sum("n").alias("n"), n_rows().alias("ids"))


@query("jn9_unambiguous_join", """
    WITH u AS (SELECT lookup_key, min(rec_id) AS rec_id FROM canon WHERE lookup_key IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
         c AS (SELECT track_id, regexp_replace(lower(concat(artist, name)), '[^a-z0-9_]', '', 'g') AS key FROM titles
               WHERE name NOT LIKE 'Té%')
    SELECT track_id, rec_id FROM c JOIN u ON c.key = u.lookup_key""")
def unambiguous_join(t):
    owners = R.single_owner(t.canon, "lookup_key", "rec_id").withColumnRenamed("lookup_key", "match_key")
    keyed = t.titles.withColumn("match_key", X.ascii_key(F.col("artist"), F.col("name")))
    return keyed.join(owners, "match_key").select("track_id", "rec_id")


@query("jn10_latest_version", """
    SELECT track_id, name, CAST(ingested AS STRING) AS ingested FROM (
        SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY ingested DESC, name) AS r FROM titles) AS x WHERE r = 1""")
def latest_version(t):
    latest = R.latest_version(t.titles, "track_id", "ingested")
    return latest.select("track_id", "name", F.col("ingested").cast("string").alias("ingested"))


@query("jn11_null_safe_keys", """
    WITH c AS (SELECT msid, mbid, lastfm, concat('T', max(k)) AS track_id FROM listens_flat GROUP BY 1, 2, 3)
    SELECT track_id, count(*) AS listens, count(DISTINCT user_tok) AS listeners FROM listens_flat l
    JOIN c ON l.msid = c.msid AND l.mbid IS NOT DISTINCT FROM c.mbid AND l.lastfm IS NOT DISTINCT FROM c.lastfm GROUP BY 1""")
def null_safe_keys(t):
    keys = ["msid", "mbid", "lastfm"]
    corr = t.listens_flat.groupBy(*keys).agg(F.concat(F.lit("T"), F.max("k").cast("string")).alias("track_id"))
    # Rows are reduced to (keys, listener) before the join: a hot key shrinks to its listeners.
    per_user = t.listens_flat.groupBy(*keys, "user_tok").agg(n_rows().alias("n"))
    joined = null_safe_join(per_user, corr, keys).groupBy("track_id", "user_tok").agg(F.sum("n").alias("n"))
    return joined.groupBy("track_id").agg(F.sum("n").alias("listens"), n_rows().alias("listeners"))


@query("jn12_replicate", """
    SELECT CASE WHEN c = 0 THEN CAST(user_id AS STRING) ELSE sha1(concat(CAST(user_id AS STRING), '#', CAST(c AS STRING))) END AS user_id,
           CAST(sum(playcount) AS BIGINT) AS plays, count(*) AS n_rows
    FROM history, range(0, 3) r(c) GROUP BY 1""")
def replicate(t):
    copies = W.replicate(t.history.withColumn("user_id", F.col("user_id").cast("string")), "user_id", 3)
    return copies.groupBy("user_id").agg(F.sum("playcount").alias("plays"), n_rows().alias("n_rows"))


@query("jn13_plan_join", """
    SELECT mois, files, count(*) AS n FROM plays JOIN (
        SELECT mois, CAST(greatest(1, ceil(count(*) * 134.7 / 65536)) AS INT) AS files FROM plays GROUP BY mois) AS p USING (mois)
    GROUP BY mois, files""")
def plan_join(t):
    from trackmetrics.sources.layout import file_plan

    plan = file_plan(t.plays, ["mois"], row_bytes=134.7, target_bytes=65536)
    # One plan row per month: the calendar bounds the broadcast.
    return t.plays.join(F.broadcast(plan), "mois").groupBy("mois", "files").agg(n_rows().alias("n"))


@query("jn14_exclude_full_load", """
    SELECT DISTINCT user_tok, ts_s, msid FROM dumps EXCEPT SELECT user_tok, ts_s, msid FROM full_load""")
def exclude_full_load(t):
    return I.without_full_load(t.dumps, t.full_load).select("user_tok", "ts_s", "msid")


@query("jn14_bloom_filter", """
    WITH k AS (SELECT DISTINCT user_tok, ts_s, msid FROM dumps WHERE reception - date > 30),
         f AS (SELECT (user_tok, ts_s, msid) IN (SELECT (user_tok, ts_s, msid) FROM k) AS held FROM full_load)
    SELECT (SELECT count(*) FROM k) AS keys, count(*) AS full_rows, count(*) FILTER (held) AS held_rows, 0 AS missed, 1 AS within_bound FROM f""")
def bloom_filter(t):
    """Rows of the full load that a filter of the late events lets through: all that they hold, and at most a twentieth of the others."""
    old = t.dumps.where(I.lateness("reception", "date") > I.LATE_DAYS).select(*I.EVENT_KEY).distinct()
    keys = materialise(old, "jn14")
    full = t.full_load.select(*I.EVENT_KEY)
    passed = may_hold(full, keys, I.EVENT_KEY).join(keys.withColumn("held", F.lit(1)), list(I.EVENT_KEY), "left")
    found = passed.agg(F.count("held").alias("passed_held"), n_rows().alias("passed"))
    exact = full.join(keys, list(I.EVENT_KEY), "left_semi").agg(n_rows()).scalar()
    size = full.agg(n_rows().alias("full_rows"), exact.alias("held_rows"))
    other = (F.col("passed") - F.col("passed_held")) <= 0.05 * (F.col("full_rows") - F.col("held_rows")) + 5
    return size.crossJoin(found).select(  # one row a side
        F.lit(keys.count()).cast("long").alias("keys"), "full_rows", "held_rows", (F.col("held_rows") - F.col("passed_held")).alias("missed"), other.cast("int").alias("within_bound")
    )


@query("jn15_pair_and_triple", """
    WITH a AS (SELECT DISTINCT ts_s, msid, user_tok FROM dumps WHERE reception - date > 30)
    SELECT (SELECT count(*) FROM a) AS triples, (SELECT count(*) FROM (SELECT DISTINCT ts_s, msid FROM a)) AS pairs,
           (SELECT count(*) FROM (SELECT DISTINCT ts_s, msid FROM a INTERSECT SELECT ts_s, msid FROM full_load)) AS pairs_found,
           (SELECT count(*) FROM (SELECT ts_s, msid, user_tok FROM a INTERSECT SELECT ts_s, msid, user_tok FROM full_load)) AS triples_found""")
def pair_and_triple(t):
    old = t.dumps.where(I.lateness("reception", "date") > I.LATE_DAYS)
    return R.witness_overlap(old, t.full_load, ["ts_s", "msid"], "user_tok")


@query("jn16_star_join", """
    SELECT genre, count(*) AS n_rows, CAST(sum(playcount) AS BIGINT) AS plays FROM history h JOIN catalog c ON h.track_id = c.track_id
    WHERE genre IS NOT NULL GROUP BY genre""")
def star_join(t):
    return W.by_attribute(t.history, t.catalog, "track_id", "genre", {"n_rows": n_rows(), "plays": F.sum("playcount")})


@query("jn17_changed_groups", """
    WITH f AS (SELECT * FROM day_facts WHERE mois <> '2001-08'),
         s AS (SELECT date, msid, CASE WHEN mois = '2001-07' THEN listens + 1 ELSE listens END AS listens, listeners FROM day_facts)
    SELECT CASE WHEN f.msid IS NULL THEN 'nouveau' ELSE 'modifie' END AS kind, count(*) AS n, CAST(sum(s.listens) AS BIGINT) AS listens
    FROM s LEFT JOIN f ON s.date = f.date AND s.msid = f.msid
    WHERE f.msid IS NULL OR f.listens <> s.listens OR f.listeners <> s.listeners GROUP BY 1""")
def changed_groups(t):
    facts = t.day_facts
    staged = facts.withColumn("listens", F.when(F.col("mois") == "2001-07", F.col("listens") + 1).otherwise(F.col("listens")))
    changed = I.differing_groups(facts.where("mois <> '2001-08'"), staged, ["date", "msid"], ["listens", "listeners"])
    return changed.groupBy("kind").agg(n_rows().alias("n"), F.sum("listens").alias("listens"))


@query("jn18_orphan_dates", """
    SELECT count(DISTINCT date) AS orphan_dates, count(*) AS facts FROM day_facts
    WHERE date < DATE '1995-03-01' OR date > DATE '2000-12-31'""")
def orphan_dates(t):
    calendar = W.calendar(t.spark, F.lit("1995-03-01").cast("date"), F.lit("2000-12-31").cast("date"))
    per_day = t.day_facts.groupBy("date").agg(n_rows().alias("n"))
    outside = per_day.join(calendar.select("date"), "date", "left_anti")
    return outside.agg(n_rows().alias("orphan_dates"), F.coalesce(F.sum("n"), F.lit(0)).alias("facts"))


_AGREE = """
    WITH d AS (SELECT rec_id, rec_id AS target FROM canon UNION ALL
               SELECT rec_id, canon_id FROM redirect WHERE rec_id NOT IN (SELECT rec_id FROM canon)),
         u AS (SELECT lookup_key, min(rec_id) AS target FROM canon WHERE lookup_key IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
         c AS (SELECT a.target AS x, b.target AS y, u.target AS z FROM listens_flat l LEFT JOIN d a ON l.mbid = a.rec_id
               LEFT JOIN d b ON l.lastfm = b.rec_id LEFT JOIN u ON l.k % 11 <> 0
                AND u.lookup_key = regexp_replace(lower(concat(artist_name, track_name)), '[^a-z0-9_]', '', 'g'))
    SELECT pair, n AS listens, same, round(100.0 * same / n, 2)::DOUBLE AS pct FROM (
        SELECT 'mbid_vs_cle' AS pair, count(*) AS n, count(*) FILTER (x = z) AS same FROM c WHERE x IS NOT NULL AND z IS NOT NULL UNION ALL
        SELECT 'mbid_vs_lastfm', count(*), count(*) FILTER (x = y) FROM c WHERE x IS NOT NULL AND y IS NOT NULL UNION ALL
        SELECT 'lastfm_vs_cle', count(*), count(*) FILTER (y = z) FROM c WHERE y IS NOT NULL AND z IS NOT NULL) AS q"""


@query("jn19_pairwise_agreement", _AGREE)
def pairwise_agreement(t):
    return R.agreement(R.resolve_stored(t.listens_flat, t.canon, t.redirect))


@query("jn20_unresolved_ids", """
    WITH d AS (SELECT rec_id FROM canon UNION SELECT rec_id FROM redirect),
         r AS (SELECT release_id AS x FROM canon UNION SELECT release_id FROM release_redirect UNION SELECT canon_release_id FROM release_redirect)
    SELECT count(*) AS listens, count(DISTINCT mbid) AS ids, count(*) FILTER (mbid IN (SELECT x FROM r)) AS release_listens,
           count(DISTINCT CASE WHEN mbid IN (SELECT x FROM r) THEN mbid END) AS release_ids
    FROM listens_flat WHERE mbid IS NOT NULL AND mbid NOT IN (SELECT rec_id FROM d)""")
def unresolved_ids(t):
    solved = R.resolve_stored(t.listens_flat, t.canon, t.redirect)
    return R.unresolved(solved, "mbid", "by_mbid", t.canon, t.release_redirect)


# -- set operations -----------------------------------------------------------


@query("set1_union_by_name", """
    SELECT src, count(*) AS n, count(DISTINCT id) AS ids FROM (
        SELECT 'canon' AS src, rec_id AS id FROM canon UNION ALL SELECT 'redirect', rec_id FROM redirect) AS u GROUP BY src""")
def union_by_name(t):
    a = t.canon.select(F.lit("canon").alias("src"), F.col("rec_id").alias("id"))
    b = t.redirect.select(F.col("rec_id").alias("id"), F.lit("redirect").alias("src"))
    return a.unionByName(b).groupBy("src").agg(n_rows().alias("n"), F.count_distinct("id").alias("ids"))


@query("set2_tagged_origins", """
    SELECT 'complet' AS origin, mois, count(*) AS n FROM full_load GROUP BY mois UNION ALL
    SELECT 'incr', mois, count(*) FROM dumps GROUP BY mois""")
def tagged_origins(t):
    both = W.tag_origins({"complet": t.full_load, "incr": t.dumps}, ["mois"])
    return both.groupBy("origin", "mois").agg(n_rows().alias("n"))


@query("set3_union_distinct", """
    SELECT release_id AS x FROM canon UNION SELECT release_id FROM release_redirect UNION SELECT canon_release_id FROM release_redirect""")
def union_distinct(t):
    return R.release_ids(t.canon, t.release_redirect)


@query("set4_shared_partitions", """
    SELECT mois FROM plays WHERE date < DATE '1998-01-01' INTERSECT SELECT mois FROM plays WHERE date >= DATE '1997-06-15'""")
def shared_partitions(t):
    early = t.plays.where("date < DATE '1998-01-01'").select("mois")
    late = t.plays.where("date >= DATE '1997-06-15'").select("mois")
    return early.intersect(late)


@query("set5_array_difference", """
    SELECT nb AS extra, count(*) AS n FROM (SELECT CASE WHEN mbid IS NULL THEN 0 ELSE 1 END + CASE WHEN lastfm IS NULL THEN 0
        WHEN lastfm IS NOT DISTINCT FROM mbid THEN 0 ELSE 1 END AS nb FROM listens_flat) AS x GROUP BY 1""")
def array_difference(t):
    seen = F.array("msid", "mbid", "lastfm")
    extra = F.size(F.array_compact(F.array_except(seen, F.array("msid"))))
    return t.listens_flat.groupBy(extra.alias("extra")).agg(n_rows().alias("n"))


@query("set6_distinct", "SELECT DISTINCT user_tok, msid FROM listens_flat")
def distinct_pairs(t):
    return t.listens_flat.select("user_tok", "msid").distinct()


# -- top-k --------------------------------------------------------------------


@query("tk1_top_groups", """
    SELECT track_id, CAST(sum(playcount) AS BIGINT) AS plays FROM history GROUP BY track_id ORDER BY plays DESC, track_id LIMIT 10""")
def top_groups(t):
    return W.top_groups(t.history, "track_id", "playcount", 10, "plays")


@query("tk2_recent_top", """
    SELECT msid, CAST(sum(listens) AS BIGINT) AS listens FROM day_facts WHERE date >= DATE '2001-07-01'
    GROUP BY msid ORDER BY listens DESC, msid LIMIT 10""")
def recent_top(t):
    return W.recent_top(t.day_facts, F.lit("2001-07-01").cast("date"), 10)


@query("tk3_top_artists", """
    SELECT artist, CAST(sum(total_plays) AS BIGINT) AS plays FROM catalog JOIN engagement USING (track_id)
    GROUP BY artist ORDER BY plays DESC, artist LIMIT 15""")
def top_artists(t):
    reference = W.artist_reference(t.catalog, t.history)
    top = reference.orderBy(F.desc("plays"), "artist").limit(15)
    return top.select("artist", "plays")


@query("tk5_shuffled_order", """
    SELECT CAST(row_number() OVER (ORDER BY h, event_id) AS BIGINT) AS rank, event_id FROM (
        SELECT event_id, md5(concat(CAST(event_id AS STRING), msid)) AS h FROM listens_flat) AS x
    QUALIFY row_number() OVER (ORDER BY h, event_id) <= 100""")
def shuffled_order(t):
    """Deterministic pseudo-random order: the first 100 rows, with their rank."""
    digest = F.md5(F.concat(F.col("event_id").cast("string"), F.col("msid")))
    first = t.listens_flat.orderBy(digest, "event_id").limit(100).select("event_id", digest.alias("h"))
    ranked = first.selectExpr("event_id", "row_number() OVER (ORDER BY h, event_id) AS rank")
    return ranked.select(F.col("rank").cast("long").alias("rank"), "event_id")


@query("tk6_ordered_diagnostics", """
    SELECT msid, count(*) AS n FROM listens_flat WHERE mbid IS NULL AND lastfm IS NULL GROUP BY msid ORDER BY n DESC, msid LIMIT 40""")
def ordered_diagnostics(t):
    unknown = t.listens_flat.where("mbid IS NULL AND lastfm IS NULL")
    return unknown.groupBy("msid").agg(n_rows().alias("n")).orderBy(F.desc("n"), "msid").limit(40)


@query("jn21_catalog_match", """
    WITH lt AS (SELECT track_id, concat(artist, name) AS full_name, spotify_id FROM titles QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY ingested DESC) = 1),
         kk AS (SELECT track_id, CASE WHEN strlen(full_name) = length(full_name) THEN regexp_replace(lower(full_name), '[^a-z0-9_]', '', 'g') END AS key,
                       CASE WHEN length(spotify_id) = 22 THEN spotify_id END AS sp FROM lt),
         k1 AS (SELECT key, min(track_id) AS t FROM kk WHERE key IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
         s1 AS (SELECT sp, min(track_id) AS t FROM kk WHERE sp IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
         u AS (SELECT lookup_key AS key, min(rec_id) AS rec FROM canon WHERE lookup_key IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
         r1 AS (SELECT rec, min(t) AS t FROM k1 JOIN u USING (key) GROUP BY 1 HAVING count(*) = 1),
         c AS (SELECT DISTINCT msid, mbid AS rec FROM listens_flat WHERE mbid IN (SELECT rec_id FROM canon)),
         l AS (SELECT msid, CASE WHEN strlen(concat(artist_name, track_name)) = length(concat(artist_name, track_name))
                                 THEN regexp_replace(lower(concat(artist_name, track_name)), '[^a-z0-9_]', '', 'g') END AS key,
                      COALESCE(CASE WHEN length(spotify_id) = 22 THEN spotify_id WHEN spotify_id LIKE '%/track/%' THEN right(spotify_id, 22) END,
                               right(spotify_uri, 22)) AS sp FROM listens_flat),
         m AS (SELECT s1.t AS a, r1.t AS b, k1.t AS d FROM l LEFT JOIN s1 ON l.sp = s1.sp LEFT JOIN c ON l.msid = c.msid LEFT JOIN r1 ON c.rec = r1.rec LEFT JOIN k1 ON l.key = k1.key)
    SELECT CASE WHEN a IS NOT NULL THEN 'spotify' WHEN b IS NOT NULL THEN 'musicbrainz' WHEN d IS NOT NULL THEN 'cle_artiste_titre' END AS route,
           count(*) AS listens, count(DISTINCT COALESCE(a, b, d)) AS tracks FROM m GROUP BY 1""")
def catalog_match(t):
    """Listens matched to catalogue tracks by external id, reference recording or name key: volume and tracks per route."""
    known = t.listens_flat.join(t.canon.select(F.col("rec_id").alias("mbid")).distinct(), "mbid", "left_semi").select("msid", F.col("mbid").alias("rec_id")).distinct()
    found = R.match_catalog(t.listens_flat, R.latest_version(t.titles, "track_id", "ingested"), known, t.canon)
    per_track = found.groupBy("route", "track_id").agg(F.sum("listens").alias("listens"))
    return per_track.groupBy("route").agg(F.sum("listens").alias("listens"), F.count("track_id").alias("tracks"))
