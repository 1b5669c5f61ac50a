"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from trackmetrics.functions import text as X
from trackmetrics.operators import catalog as C
from trackmetrics.operators import profiling as P
from trackmetrics.plans.registry import query


@query("prj1_typed_select", """
    SELECT CAST(user_id AS STRING) AS user, CAST(track_id AS STRING) AS track, CAST(playcount AS INT) AS plays FROM history""")
def typed_select(t):
    raw = t.history.select(*[F.col(c).cast("string") for c in ("user_id", "track_id", "playcount")])
    return raw.select(
        F.col("user_id").alias("user"), F.col("track_id").alias("track"), F.col("playcount").try_cast("int").alias("plays")
    )


@query("prj2_text_clean", """
    SELECT track_id, trim(name) AS name, trim(artist) AS artist, lower(trim(genre)) AS genre FROM catalog""")
def text_clean(t):
    return C.clean_names(t.catalog).select("track_id", "name", "artist", "genre")


@query("prj3_sentinel_year", "SELECT track_id, CASE WHEN year > 1900 THEN year END AS year FROM catalog")
def sentinel_year(t):
    return t.catalog.select("track_id", X.real_year(F.col("year")).alias("year"))


@query("prj4_derived_numbers", """
    SELECT track_id, ((duration_ms + 30) // 60)::DOUBLE / 1000 AS duration_min,
           CASE WHEN tags IS NULL THEN 0 ELSE len(string_split(tags, ',')) END AS nb_tags FROM catalog""")
def derived_numbers(t):
    return t.catalog.select(
        "track_id", X.minutes(F.col("duration_ms")).alias("duration_min"), X.tag_count(F.col("tags")).alias("nb_tags")
    )


@query("prj5_key_filter", """
    SELECT doc_id, nom FROM tags_raw WHERE nom IS NOT NULL AND length(trim(nom)) > 0""")
def key_filter(t):
    return t.tags_raw.where(X.not_blank(F.col("nom"))).select("doc_id", "nom")


@query("prj6_drop_all_null", """
    SELECT event_id FROM listens_flat
    WHERE mbid IS NOT NULL OR lastfm IS NOT NULL OR spotify_id IS NOT NULL""")
def drop_all_null(t):
    return t.listens_flat.dropna(how="all", subset=["mbid", "lastfm", "spotify_id"]).select("event_id")


@query("prj7_out_of_bounds", """
    SELECT 'danceability' AS column_name, count(*) FILTER (danceability < 0 OR danceability > 1) AS out_of_bounds FROM catalog
    UNION ALL SELECT 'energy', count(*) FILTER (energy < 0 OR energy > 1) FROM catalog
    UNION ALL SELECT 'speechiness', count(*) FILTER (speechiness < 0 OR speechiness > 1) FROM catalog
    UNION ALL SELECT 'acousticness', count(*) FILTER (acousticness < 0 OR acousticness > 1) FROM catalog
    UNION ALL SELECT 'instrumentalness', count(*) FILTER (instrumentalness < 0 OR instrumentalness > 1) FROM catalog
    UNION ALL SELECT 'liveness', count(*) FILTER (liveness < 0 OR liveness > 1) FROM catalog
    UNION ALL SELECT 'valence', count(*) FILTER (valence < 0 OR valence > 1) FROM catalog
    UNION ALL SELECT 'loudness', count(*) FILTER (loudness < -60 OR loudness > 5) FROM catalog
    UNION ALL SELECT 'tempo', count(*) FILTER (tempo < 0 OR tempo > 250) FROM catalog
    UNION ALL SELECT 'key', count(*) FILTER (key < -1 OR key > 11) FROM catalog
    UNION ALL SELECT 'mode', count(*) FILTER (mode < 0 OR mode > 1) FROM catalog
    UNION ALL SELECT 'time_signature', count(*) FILTER (time_signature < 0 OR time_signature > 7) FROM catalog""")
def out_of_bounds(t):
    return P.out_of_bounds(t.catalog, C.BOUNDS)


@query("prj8_format_predicates", """
    SELECT count(*) AS n, count(*) FILTER (regexp_full_match(user_tok, '[0-9a-f]{32}')) AS tokens,
           count(*) FILTER (regexp_full_match(mbid, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}')) AS uuids,
           count(*) FILTER (regexp_full_match(msid, '[0-9a-f]+')) AS hex_ids FROM listens_flat""")
def format_predicates(t):
    return t.listens_flat.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("user_tok").rlike(X.HEX32)).alias("tokens"),
        F.count_if(F.col("mbid").rlike(X.UUID)).alias("uuids"),
        F.count_if(F.col("msid").rlike("^[0-9a-f]+$")).alias("hex_ids"),
    )


@query("prj9_first_with_origin", """
    SELECT event_id, COALESCE(mbid, lastfm, spotify_id) AS value,
           CASE WHEN mbid IS NOT NULL THEN 'mbid' WHEN lastfm IS NOT NULL THEN 'lastfm'
                WHEN spotify_id IS NOT NULL THEN 'spotify' END AS origin FROM listens_flat""")
def first_with_origin(t):
    value, origin = X.first_with_origin(
        [("mbid", F.col("mbid")), ("lastfm", F.col("lastfm")), ("spotify", F.col("spotify_id"))]
    )
    return t.listens_flat.select("event_id", value.alias("value"), origin.alias("origin"))


@query("prj10_scalar_or_list", """
    SELECT event_id, array_to_string(CASE WHEN mbid IS NOT NULL THEN [mbid, lastfm] WHEN lastfm IS NOT NULL THEN [lastfm]
           ELSE [msid] END, ',') AS ids FROM listens_flat""")
def scalar_or_list(t):
    both = F.when(F.col("mbid").isNotNull(), F.array("mbid", "lastfm"))
    ids = X.scalar_or_list(both, (F.col("lastfm"),), F.array("msid"))
    return t.listens_flat.select("event_id", F.array_join(ids, ",").alias("ids"))


@query("prj12_lateness_bands", """
    SELECT CASE WHEN r < 0 THEN 'a_negatif' WHEN r = 0 THEN 'b_0j' WHEN r = 1 THEN 'c_1j' WHEN r <= 7 THEN 'd_2-7j'
                WHEN r <= 30 THEN 'e_8-30j' WHEN r <= 365 THEN 'f_31-365j' ELSE 'g_plus_365j' END AS band,
           count(*) AS n, count(DISTINCT date) AS days
    FROM (SELECT date, reception - date AS r FROM dumps) AS x GROUP BY 1""")
def lateness_bands(t):
    from trackmetrics.operators.incremental import lateness_bands as bands

    return bands(t.dumps, "reception", "date")


@query("prj15_column_whitelist", """
    SELECT unnest([{'status': 'missing', 'column_name': 'ip', 'filled': NULL::BIGINT},
        {'status': 'present', 'column_name': 'doc_id', 'filled': count(doc_id)},
        {'status': 'present', 'column_name': 'lang', 'filled': count(lang)},
        {'status': 'forbidden', 'column_name': 'source', 'filled': count(source)},
        {'status': 'unexpected', 'column_name': 'n_chars', 'filled': count(n_chars)},
        {'status': 'present', 'column_name': 'text', 'filled': count(text)}], recursive := true) FROM documents""")
def column_whitelist(t):
    return P.column_check(t.documents, ["doc_id", "lang", "text", "ip"], forbidden=["source", "user_id", "email"])


@query("prj16_ascii_key", """
    SELECT event_id, CASE WHEN regexp_full_match(concat(artist_name, track_name), '[\\x00-\\x7F]*')
        THEN NULLIF(regexp_replace(lower(concat(artist_name, track_name)), '[^a-z0-9_]', '', 'g'), '') END AS match_key
    FROM listens_flat""")
def ascii_key(t):
    return t.listens_flat.select("event_id", X.ascii_key(F.col("artist_name"), F.col("track_name")).alias("match_key"))


@query("prj17_external_ids", """
    SELECT event_id, CASE WHEN spotify_id IS NULL THEN 'absent'
             WHEN spotify_id LIKE 'http%/track/%' THEN 'url_track' WHEN spotify_id LIKE 'spotify:track:%' THEN 'uri_track'
             WHEN length(spotify_id) = 22 THEN 'nu_22' ELSE 'autre' END AS fmt,
           COALESCE(CASE WHEN length(spotify_id) = 22 THEN spotify_id WHEN spotify_id LIKE '%/track/%' THEN right(spotify_id, 22) END,
                    right(spotify_uri, 22)) AS sp FROM listens_flat""")
def external_ids(t):
    sp = F.coalesce(X.spotify_track(F.col("spotify_id")), X.spotify_track(F.col("spotify_uri")))
    return t.listens_flat.select("event_id", X.spotify_format(F.col("spotify_id")).alias("fmt"), sp.alias("sp"))


@query("prj18_tag_normaliser", """
    SELECT DISTINCT nom, NULLIF(CASE tag WHEN 'und' THEN 'and' ELSE tag END, '') AS tag FROM (
        SELECT nom, trim(regexp_replace(regexp_replace(replace(lower(nom), '&', ' and '), '[/_-]+', ' ', 'g'), '\\s+', ' ', 'g')) AS tag
        FROM tags_raw) AS x""")
def tag_normaliser(t):
    synonyms = t.spark.createDataFrame([("und", "and")], "from_tag string, to_tag string")
    return X.normalise_names(t.tags_raw, "nom", synonyms)


@query("prj19_decade_and_label", """
    SELECT CASE WHEN year IS NULL OR year <= 0 THEN 'inconnue' ELSE concat(CAST(year // 10 AS STRING), '0s') END AS decade,
           CASE WHEN genre IS NULL THEN '(absent)' ELSE genre END AS genre, count(*) AS n FROM catalog GROUP BY 1, 2""")
def decade_and_label(t):
    keys = t.catalog.select(X.decade(F.col("year")).alias("decade"), X.genre_label(F.col("genre")).alias("genre"))
    return keys.groupBy("decade", "genre").agg(F.count(F.lit(1)).alias("n"))


@query("prj20_month_range", """
    SELECT mois, count(*) AS n FROM plays WHERE mois BETWEEN '1996-03' AND '1997-02' GROUP BY mois""")
def month_range(t):
    picked = t.plays.where(F.col("mois").between("1996-03", "1997-02"))
    return picked.groupBy("mois").agg(F.count(F.lit(1)).alias("n"))


@query("prj21_half_open_range", """
    SELECT count(*) AS n, CAST(sum(qty) AS BIGINT) AS plays FROM plays
    WHERE date >= DATE '1996-06-01' AND date < DATE '1996-07-01'""")
def half_open_range(t):
    day = F.col("date")
    picked = t.plays.where((day >= F.lit("1996-06-01").cast("date")) & (day < F.lit("1996-07-01").cast("date")))
    return picked.agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("plays"))
