"""Input views over the test tables, in SQL that Spark and DuckDB both accept.

Each view stands in for an input of the operators (catalogue, play counts, raw
and flattened listens, batches, reference recordings, ...).  The few functions
the two engines name differently are written as ``FN[...]`` markers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from trackmetrics.functions.staging import compute_once
from trackmetrics.session import materialise, pin_utc, size_shuffles

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _uuid(text: str) -> str:
    m = f"md5({text})"
    return (
        f"concat_ws('-', substr({m},1,8), substr({m},9,4), substr({m},13,4), substr({m},17,4), substr({m},21,12))"
    )


def _num(prefix: str, column: str) -> str:
    return f"concat('{prefix}', CAST({column} AS STRING))"


_SPOTIFY = "substr(md5(concat('s', CAST(k AS STRING))), 1, 22)"
_TITLE = f"CASE WHEN k % 11 = 0 THEN {_num('Té ', 'k')} ELSE {_num('Song! ', 'k')} END"
_ARTIST = _num("Artist ", "k % 8")
_KEY = "NULLIF(REPLACE_ALL[lower(concat(artist_name, rec_name))|[^a-z0-9_]|], '')"

VIEWS: dict[str, str] = {
    # -- catalogue and play counts -------------------------------------------------
    "catalog": """
        SELECT p_partkey AS track_id, concat(' ', p_name, ' ') AS name, p_brand AS artist,
               CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat(' ', p_type) END AS genre,
               CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1970 + p_size END AS year,
               CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE REPLACE_ALL[p_name| |,] END AS tags,
               CAST(p_size * 1000 + p_partkey AS INT) AS duration_ms,
               CAST(p_partkey % 101 AS DOUBLE) / 100 AS danceability,
               CASE WHEN p_partkey % 250 = 7 THEN 1.5 ELSE CAST(p_size AS DOUBLE) / 50 END AS energy,
               CAST(p_partkey % 12 AS INT) AS key,
               CAST(-(p_partkey % 60) AS DOUBLE) AS loudness,
               CAST(p_partkey % 2 AS INT) AS mode,
               CAST(p_size % 10 AS DOUBLE) / 10 AS speechiness,
               CAST(p_partkey % 37 AS DOUBLE) / 37 AS acousticness,
               CAST(p_partkey % 11 AS DOUBLE) / 10 AS instrumentalness,
               CAST(p_size % 7 AS DOUBLE) / 7 AS liveness,
               CASE WHEN p_partkey % 199 = 5 THEN NULL ELSE CAST(p_partkey % 53 AS DOUBLE) / 53 END AS valence,
               p_retailprice / 8 AS tempo,
               CAST(3 + p_partkey % 3 AS INT) AS time_signature
        FROM part""",
    "plays": """
        SELECT o_custkey AS user_id, l_partkey AS track_id, CAST(l_quantity AS BIGINT) AS qty,
               CAST(o_orderdate AS DATE) AS date, substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS mois
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "history": """
        SELECT user_id, track_id, CAST(sum(qty) AS INT) AS playcount FROM plays GROUP BY user_id, track_id""",
    "engagement": """
        SELECT track_id, CAST(sum(playcount) AS BIGINT) AS total_plays,
               count(DISTINCT user_id) AS unique_listeners, max(playcount) AS max_playcount,
               CAST(sum(CASE WHEN playcount > 5 THEN 1 ELSE 0 END) AS BIGINT) AS loyal_listeners
        FROM history GROUP BY track_id""",
    "day_facts": """
        SELECT date, mois, concat('m', CAST(track_id AS STRING)) AS msid,
               CAST(sum(qty) AS BIGINT) AS listens, count(DISTINCT user_id) AS listeners
        FROM plays GROUP BY date, mois, track_id""",
    # -- listens -------------------------------------------------------------------
    "listens": """
        SELECT event_id, user_id, EPOCH[ts] AS ts_s, CAST(ts AS DATE) AS date,
               substr(CAST(CAST(ts AS DATE) AS STRING), 1, 7) AS mois, CAST(JSONPATH[props|$.k] AS INT) AS k,
               event_type, value
        FROM events""",
    "listens_flat": f"""
        SELECT event_id, md5({_num('u', 'user_id')}) AS user_tok, ts_s, date, mois, event_type, k,
               {_num('m', 'k')} AS msid,
               CASE WHEN k % 35 = 0 THEN {_uuid(_num('l', 'k'))} WHEN k % 5 = 0 THEN {_uuid(_num('r', 'k'))} END AS mbid,
               CASE WHEN k % 3 = 0 THEN {_uuid(_num('r', 'k'))} END AS lastfm,
               {_ARTIST} AS artist_name, {_TITLE} AS track_name,
               CASE WHEN k % 7 = 0 THEN concat('https://open.spotify.com/track/', {_SPOTIFY})
                    WHEN k % 7 = 1 THEN {_SPOTIFY}
                    WHEN k % 7 = 2 THEN concat('https://open.spotify.com/album/', {_SPOTIFY}) END AS spotify_id,
               CASE WHEN k % 7 = 3 THEN concat('spotify:track:', {_SPOTIFY}) END AS spotify_uri,
               event_id % 97 = 0 AS private_flag
        FROM listens""",
    "full_load": "SELECT * FROM listens_flat WHERE event_type IN ('view', 'click')",
    # -- reference recordings ------------------------------------------------------
    "titles_k": "SELECT DISTINCT k FROM listens",
    "canon": f"""
        SELECT rec_id, artist_name, rec_name, {_KEY} AS lookup_key, release_id FROM (
            SELECT {_uuid(_num('r', 'k'))} AS rec_id, {_ARTIST} AS artist_name, {_TITLE} AS rec_name,
                   {_uuid(_num('l', 'k'))} AS release_id
            FROM titles_k WHERE k % 4 <> 1
            UNION ALL
            SELECT {_uuid(_num('x', 'k'))}, {_ARTIST}, {_TITLE}, {_uuid(_num('l', 'k'))}
            FROM titles_k WHERE k % 20 = 2) AS c""",
    "redirect": f"""
        SELECT {_uuid(_num('r', 'k'))} AS rec_id, {_uuid(_num('r', '(k - 1)'))} AS canon_id
        FROM titles_k WHERE k % 4 = 1""",
    "release_redirect": f"""
        SELECT {_uuid(_num('q', 'k'))} AS release_id, {_uuid(_num('l', 'k'))} AS canon_release_id
        FROM titles_k WHERE k % 3 = 0""",
    # -- catalogue titles that may match listens, with an older version of some ----
    "titles": f"""
        SELECT {_num('K', 'k')} AS track_id, {_TITLE} AS name, {_ARTIST} AS artist,
               CASE WHEN k % 2 = 0 THEN {_SPOTIFY} WHEN k % 9 = 1 THEN 'bad' END AS spotify_id,
               DATE '2026-09-10' AS ingested FROM titles_k WHERE k % 3 <> 1
        UNION ALL
        SELECT {_num('K', 'k')}, {_num('Old ', 'k')}, {_ARTIST}, NULL, DATE '2026-09-01'
        FROM titles_k WHERE k % 6 = 0
        UNION ALL
        SELECT {_num('X', 'k')}, {_TITLE}, {_ARTIST}, NULL, DATE '2026-09-10'
        FROM titles_k WHERE k % 25 = 2""",
    # -- incremental batches -------------------------------------------------------
    "dumps": """
        SELECT l.*, date + CAST(CASE WHEN event_id % 20 = 0 THEN 40 WHEN event_id % 7 = 0 THEN 3
                                     WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INT) AS reception
        FROM listens_flat l
        UNION ALL
        SELECT l.*, date + 1 AS reception FROM listens_flat l WHERE event_id % 50 = 0""",
    "manifest": """
        SELECT reception AS dump, min(ts_s) AS first_ts, max(ts_s) AS last_ts, count(*) AS n
        FROM dumps GROUP BY reception""",
    # One batch per order day, bounds contiguous except a planted gap and a planted overlap.
    "batches": """
        SELECT no, lag(d, 1, DATE '1994-12-31') OVER (ORDER BY no) AS prev_day, d AS day, n,
               CASE WHEN no % 400 = 150 THEN 3600 WHEN no % 400 = 300 THEN -3600 ELSE 0 END AS shift_s
        FROM (SELECT CAST(row_number() OVER (ORDER BY d) AS INT) + 2000 AS no, d, n
              FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) AS x) AS y""",
    "bounds": """
        SELECT no, DAYSTART[prev_day] + shift_s AS start_s, DAYSTART[day] AS end_s, n, day FROM batches""",
    # -- tags ----------------------------------------------------------------------
    "tags_raw": """
        SELECT doc_id, nom, CAST(length(nom) % 5 - 1 AS INT) AS votes
        FROM (SELECT doc_id, WORDS[text] AS nom FROM documents) AS w WHERE nom <> ''""",
    # -- labels and scores ---------------------------------------------------------
    "scores": """
        SELECT doc_id, quality, toxic, n_chars FROM labels JOIN documents USING (doc_id)""",
    # -- raw JSON with planted defects ----------------------------------------------
    "raw_listens": """
        SELECT event_id, ts_s, date, mois, k, user_tok, msid, mbid, artist_name, track_name, private_flag,
               event_id % 401 = 0 AS truncated, event_id % 307 = 0 AS no_track, event_id % 211 = 0 AS has_ip,
               event_id % 503 = 0 AS has_new, event_id % 701 = 0 AS drift, event_id % 3 = 0 AS discarded
        FROM listens_flat""",
}

_SPARK = {
    "EPOCH": lambda x: f"unix_timestamp(CAST({x} AS TIMESTAMP))",
    "DAYSTART": lambda x: f"unix_timestamp(CAST({x} AS TIMESTAMP))",
    "JSONPATH": lambda x, p: f"get_json_object({x}, '{p}')",
    "REPLACE_ALL": lambda x, p, r: f"regexp_replace({x}, '{p}', '{r}')",
    "WORDS": lambda x: f"explode(split({x}, ' '))",
}
_DUCKDB = {
    "EPOCH": lambda x: f"(epoch_us({x}) // 1000000)",
    "DAYSTART": lambda x: f"(epoch_us(CAST({x} AS TIMESTAMP)) // 1000000)",
    "JSONPATH": lambda x, p: f"json_extract_string({x}, '{p}')",
    "REPLACE_ALL": lambda x, p, r: f"regexp_replace({x}, '{p}', '{r}', 'g')",
    "WORDS": lambda x: f"unnest(string_split({x}, ' '))",
}


def _render(sql: str, dialect: dict) -> str:
    marker = re.compile(r"\b(" + "|".join(dialect) + r")\[")
    while found := marker.search(sql):
        depth, at = 1, found.end()
        while depth:
            depth += {"[": 1, "]": -1}.get(sql[at], 0)
            at += 1
        arguments = sql[found.end() : at - 1].split("|")
        sql = sql[: found.start()] + dialect[found.group(1)](*arguments) + sql[at:]
    return sql


def _with_views(body: str) -> str:
    """Prefix ``body`` with the definitions of the views it names, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b(FROM|JOIN|USING_VIEW)\s+{name}\b", text, re.IGNORECASE) and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    clauses = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    stripped = body.strip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {clauses},\n{stripped[5:]}"
    return f"WITH {clauses}\n{stripped}"


def duckdb_query(body: str) -> str:
    """Oracle SQL over the registered tables, with the views it uses in front."""
    return _render(_with_views(body), _DUCKDB)


class Tables:
    """The base tables and views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_utc(spark)
        self.folder = folder.rstrip("/")
        size_shuffles(spark, self.folder)
        self._kept: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def sql(self, body: str) -> DataFrame:
        text = _render(_with_views(body), _SPARK)
        for table in BASE_TABLES:
            text = re.sub(rf"\b(FROM|JOIN)\s+{table}\b", rf"\1 parquet.`{self.path(table)}` AS {table}", text)
        return self.spark.sql(text)

    def keep(self, *views: str) -> Tables:
        """Store views in the shared folder, so that queries read them like loaded tables."""
        for view in views:
            self._kept[view] = materialise(self.sql(f"SELECT * FROM {view}"), view)
        return self

    def __getattr__(self, name: str) -> DataFrame:
        if name in self.__dict__.get("_kept", {}):
            return self._kept[name]
        if name in BASE_TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)


def raw_json(t: Tables) -> DataFrame:
    """Raw JSON lines (date, mois, value) of ``raw_listens``, with its planted defects written out."""
    from pyspark.sql import functions as F

    c = F.col
    info = F.struct(
        c("mbid").alias("recording_mbid"),
        (c("k") * 997 + 61_000).alias("duration_ms"),
        F.when(c("k") % 13 == 0, "side B").otherwise((c("k") % 17 + 1).cast("string")).alias("tracknumber"),
        F.when(c("private_flag"), F.lit(True)).alias("incognito_mode"),
        F.when(c("has_ip"), "198.51.100.7").alias("ip_addr"),
        F.when(c("has_new"), F.lit(0)).alias("new_key"),
        F.when(c("discarded"), "player://local").alias("origin_url"),
    )
    artist = F.struct(F.md5("artist_name").alias("artist_mbid"), c("artist_name").alias("artist_credit_name"), F.lit("").alias("join_phrase"))
    mapping = F.struct(c("mbid").alias("recording_mbid"), F.array(artist).alias("artists"))
    metadata = F.struct(
        "artist_name",
        F.when(~c("no_track"), c("track_name")).alias("track_name"),
        F.when(c("drift"), "@77").otherwise(F.concat(F.lit("Record no. "), (c("k") % 4).cast("string"))).alias("release_name"),
        info.alias("additional_info"),
        F.when(c("mbid").isNotNull(), mapping).alias("mbid_mapping"),
    )
    line = F.to_json(F.struct(
        c("user_tok").alias("user_id"), c("ts_s").alias("timestamp"), c("msid").alias("recording_msid"), metadata.alias("track_metadata"),
    ))
    line = F.replace(line, F.lit('"@77"'), F.lit("77"))
    cut = F.when(c("truncated"), F.substring(line, F.lit(1), F.length(line) - 7)).otherwise(line)
    # Computed once: a filter on the text must not copy the writer expression below itself.
    return compute_once(t.raw_listens, value=cut).select("event_id", "date", "mois", "value")


def loadable_json(t: Tables) -> DataFrame:
    """Raw JSON lines (date, mois, value) without those that make the contract refuse a whole batch: forbidden or new keys, a
    mandatory field gone.  Cut lines, drifted types, discarded keys and private events stay."""
    fit = t.raw_listens.where("NOT (has_ip OR has_new OR no_track)").select("event_id")
    return raw_json(t).join(fit, "event_id", "left_semi").drop("event_id")
