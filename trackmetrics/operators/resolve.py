"""Entity resolution: from the ids and names written in events to reference recordings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.functions import text as X
from trackmetrics.operators.bloom import may_hold
from trackmetrics.operators.skew import first_by, lookup
from trackmetrics.session import materialise

# Resolution methods in order of preference.
METHODS = ("mbid_direct", "mbid_redirection", "lastfm", "cle_artiste_titre")
NO_METHOD = "aucune"
KEY_AGREEMENT = 0.99


def orphans(rows: DataFrame, reference: DataFrame, key: str, measures: Mapping[str, Column]) -> DataFrame:
    """Keys of ``rows`` absent from ``reference``; rows are grouped first, so a hot key is one row in the join."""
    grouped = rows.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()])
    return grouped.join(reference.select(key), key, "left_anti")


def overlap(batch: DataFrame, table: DataFrame, key: list[str], partial: list[str]) -> DataFrame:
    """Rows of ``batch`` found in ``table`` by the full key and by the part of it that ignores the listener."""
    grouped = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    stored = table.select(*key).distinct()
    full = grouped.join(stored, key, "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    pairs = grouped.groupBy(*partial).agg(F.sum("n").alias("n"))
    loose = pairs.join(stored.select(*partial).distinct(), partial, "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    total = grouped.agg(F.sum("n").alias("batch_rows"))
    return total.select("batch_rows", full.alias("same_triple"), loose.alias("same_pair"))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_n: str, right_n: str) -> DataFrame:
    """Full outer comparison of two count tables."""
    joined = left.join(right, key, "full_outer")
    return joined.withColumn("differs", (~F.col(left_n).eqNullSafe(F.col(right_n))).cast("int"))


def populations(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of both / left only / right only, for two sets of keys."""
    marked = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    sides = marked.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    name = F.when(F.col("l") == 0, "right_only").when(F.col("r") == 0, "left_only").otherwise("both")
    return sides.groupBy(name.alias("population")).agg(F.count(F.lit(1)).alias("n"))


def combinations(listens: DataFrame) -> DataFrame:
    """Listens reduced to their distinct identifying combination, with the number of listens."""
    key = X.ascii_key(F.col("artist_name"), F.col("track_name"))
    return listens.groupBy("msid", "mbid", "lastfm", key.alias("match_key")).agg(F.count(F.lit(1)).alias("listens"))


def resolver(canon: DataFrame, redirect: DataFrame) -> DataFrame:
    """Any known recording id -> canonical id: direct ids, then redirected ids that are not direct."""
    direct = canon.select("rec_id", F.col("rec_id").alias("target"), F.lit("direct").alias("route"))
    moved = redirect.join(canon.select("rec_id"), "rec_id", "left_anti")
    return direct.unionByName(moved.select("rec_id", F.col("canon_id").alias("target"), F.lit("redirection").alias("route")))


def attach_route(ids: DataFrame, key: str, canon: DataFrame, redirect: DataFrame) -> DataFrame:
    known = resolver(canon, redirect).withColumnRenamed("rec_id", key)
    return ids.join(known, key, "left").withColumn("route", F.coalesce("route", F.lit("hors_canonique")))


def single_owner(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys that belong to exactly one owner."""
    owners = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(owner).alias(owner))
    return owners.where(F.col("__n") == 1).drop("__n")


def latest_version(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the newest version, ties broken by the other columns."""
    others = [F.col(c) for c in df.columns if c not in (key, version)]
    newest = F.datediff(F.lit("9999-12-31").cast("date"), F.col(version))  # null versions come last
    return first_by(df, [key], [newest, *others])


def key_hypothesis(canon: DataFrame) -> DataFrame:
    """How often the computed match key equals the stored one, on ASCII names; used from 99 % on."""
    name = F.concat_ws("", "artist_name", "rec_name")
    same = X.ascii_key(name).eqNullSafe(F.col("lookup_key"))
    one = canon.where(name.rlike(X.ASCII)).agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("ok"))
    rate = F.coalesce(F.try_divide(F.col("ok"), F.col("n")), F.lit(0.0))
    return one.select("n", "ok", F.round(rate, 5).alias("rate"), (rate >= KEY_AGREEMENT).cast("int").alias("accepted"))


@dataclass(frozen=True)
class Source:
    """One way to a recording: the id column of the listens, the column of its answer, and the table (id, answer[, route])."""

    key: str
    answer: str
    table: DataFrame


def sources(canon: DataFrame, redirect: DataFrame) -> list[Source]:
    """The sources in order of preference.

    The table of match keys is empty unless :func:`key_hypothesis` accepts the key, which a scalar subquery decides inside the plan.
    """
    known = resolver(canon, redirect)
    accepted = key_hypothesis(canon).select("accepted").scalar() == 1
    owned = single_owner(canon, "lookup_key", "rec_id").where(accepted)
    return [
        Source("mbid", "by_mbid", known.select(F.col("rec_id").alias("mbid"), F.col("target").alias("by_mbid"), "route")),
        Source("lastfm", "by_lastfm", known.select(F.col("rec_id").alias("lastfm"), F.col("target").alias("by_lastfm"))),
        Source("match_key", "by_key", owned.select(F.col("lookup_key").alias("match_key"), F.col("rec_id").alias("by_key"))),
    ]


def resolve(combos: DataFrame, canon: DataFrame, redirect: DataFrame) -> DataFrame:
    """Each combination with the answer of every source, and with method and rec_id of the first that answers.

    :func:`lookup` spreads the rows that lack an id and splits hot ids.
    """
    found = combos
    used = sources(canon, redirect)
    for source in used:
        spread = [c for c in combos.columns if c not in (source.key, "listens")]
        found = lookup(found, source.table, source.key, spread, combos)
    names = {"by_mbid": F.concat(F.lit("mbid_"), F.col("route")), "by_lastfm": F.lit(METHODS[2]), "by_key": F.lit(METHODS[3])}
    answers = [F.when(F.col(s.answer).isNotNull(), F.struct(names[s.answer].alias("method"), F.col(s.answer).alias("rec_id"))) for s in used]
    none = F.struct(F.lit(NO_METHOD).alias("method"), F.lit(None).cast("string").alias("rec_id"))
    return found.withColumn("__best", F.coalesce(*answers, none)).select("*", "__best.method", "__best.rec_id").drop("__best")


def resolve_stored(listens: DataFrame, canon: DataFrame, redirect: DataFrame) -> DataFrame:
    """:func:`resolve` with its two stages written to the shared folder.

    The combinations are read by every lookup and the result by every measure,
    so both are cheaper to store than to compute again.
    """
    combos = materialise(combinations(listens), "combinations")
    return materialise(resolve(combos, canon, redirect), "resolved")


#: What :func:`coverage` reports: name of the measure and the column that must hold a value (or a value to equal).
COVERAGE = {
    "mbid_present": "mbid", "mbid_solved": "by_mbid", "mbid_redirected": ("route", "redirection"), "lastfm_present": "lastfm",
    "lastfm_solved": "by_lastfm", "key_present": "match_key", "key_solved": "by_key", "solved": "rec_id",
}


def coverage(solved: DataFrame) -> DataFrame:
    """Listens covered by each source and by each step, in one aggregate."""
    measures = [F.sum("listens").alias("total")]
    for name, wanted in COVERAGE.items():
        holds = F.col(wanted).isNotNull() if isinstance(wanted, str) else F.col(wanted[0]) == wanted[1]
        measures.append(F.sum(F.when(holds, F.col("listens")).otherwise(0)).alias(name))
    return solved.agg(*measures)


def majority(solved: DataFrame) -> DataFrame:
    """msid -> recording: most listens, then the preferred method, then the id.

    The choice is ``min(struct)`` over (msid, recording) totals, so no msid needs a window.
    """
    rank = F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.col("method"))
    totals = solved.groupBy("msid").agg(F.sum("listens").alias("msid_listens"))
    per_choice = solved.where(F.col("rec_id").isNotNull()).groupBy("msid", "rec_id").agg(
        F.sum("listens").alias("listens"), F.min(rank).alias("rank")
    )
    best = per_choice.groupBy("msid").agg(F.min(F.struct(-F.col("listens"), "rank", "rec_id", "listens")).alias("b"))
    joined = best.join(totals, "msid")
    return joined.select(
        "msid", F.col("b.rec_id").alias("rec_id"),
        F.element_at(F.array(*[F.lit(m) for m in METHODS]), F.col("b.rank").cast("int")).alias("method"),
        "msid_listens", F.col("b.listens").alias("choice_listens"),
        F.round(F.col("b.listens") / F.col("msid_listens"), 4).alias("share"),
    )


def agreement(solved: DataFrame, pairs: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """For each pair of methods: listens where both answer, and where they agree."""
    pairs = pairs or {
        "mbid_vs_cle": ("by_mbid", "by_key"), "mbid_vs_lastfm": ("by_mbid", "by_lastfm"), "lastfm_vs_cle": ("by_lastfm", "by_key"),
    }
    rows = []
    for name, (a, b) in pairs.items():
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        n = F.sum(F.when(both, F.col("listens")).otherwise(0))
        same = F.sum(F.when(both & (F.col(a) == F.col(b)), F.col("listens")).otherwise(0))
        pct = F.round(F.try_divide(F.lit(100.0) * same, n), 2)
        rows.append(F.struct(F.lit(name).alias("pair"), n.alias("listens"), same.alias("same"), pct.alias("pct")))
    return solved.agg(F.array(*rows).alias("a")).select(F.inline("a"))


def release_ids(canon: DataFrame, release_redirect: DataFrame) -> DataFrame:
    return (
        canon.select(F.col("release_id").alias("x"))
        .unionByName(release_redirect.select(F.col("release_id").alias("x")))
        .unionByName(release_redirect.select(F.col("canon_release_id").alias("x")))
        .distinct()
    )


def unresolved(solved: DataFrame, id_column: str, answer: str, canon: DataFrame, release_redirect: DataFrame) -> DataFrame:
    """Ids without a recording: how many listens, and how many are in fact release ids."""
    missing = solved.where(F.col(id_column).isNotNull() & F.col(answer).isNull())
    per_id = missing.groupBy(id_column).agg(F.sum("listens").alias("listens"))
    releases = release_ids(canon, release_redirect).select(F.col("x").alias(id_column), F.lit(True).alias("is_release"))
    marked = per_id.join(releases, id_column, "left")
    release = F.col("is_release").isNotNull()
    return marked.agg(
        F.sum("listens").alias("listens"), F.count(F.lit(1)).alias("ids"),
        F.sum(F.when(release, F.col("listens")).otherwise(0)).alias("release_listens"),
        F.count_if(release).alias("release_ids"),
    )


def witness_overlap(batch: DataFrame, table: DataFrame, pair: list[str], token: str) -> DataFrame:
    """Overlap on a pair that ignores the token, and on the triple with it.

    Many pairs but no triple found means that the two tables were tokenised
    differently.  Both sides are reduced to distinct triples and pairs first;
    rows of the table without a pair of the batch are left out by a Bloom filter before they are shuffled.
    """
    triples = materialise(batch.select(*pair, token).distinct(), "triples")
    pairs = triples.select(*pair).distinct()
    stored = may_hold(table.select(*pair, token), pairs, pair).distinct()
    size = F.count(F.lit(1))
    found_pairs = pairs.join(stored.select(*pair).distinct(), pair, "left_semi").agg(size).scalar()
    found_triples = triples.join(stored, [*pair, token], "left_semi").agg(size).scalar()
    return triples.agg(size.alias("triples")).select(
        "triples", pairs.agg(size).scalar().alias("pairs"),
        found_pairs.alias("pairs_found"), found_triples.alias("triples_found"),
    )


def same_salt(left: DataFrame, right: DataFrame, token: str) -> DataFrame:
    """Tokens of one table that occur in the other; zero means that the salts differ."""
    a, b = left.select(token).distinct(), right.select(token).distinct()
    common = a.join(b, token, "left_semi").agg(F.count(F.lit(1))).scalar()
    return a.agg(
        F.count(F.lit(1)).alias("left_tokens"), F.count_if(~F.col(token).rlike(X.HEX32)).alias("not_hex"),
    ).select("left_tokens", "not_hex", common.alias("common"))


def match_catalog(listens: DataFrame, titles: DataFrame, correspondence: DataFrame, canon: DataFrame) -> DataFrame:
    """Listens -> catalogue tracks by three routes: external id, reference recording, name key.

    ``titles`` has one row per track.  Every route uses keys with a single owner.
    """
    keyed = titles.select(
        "track_id", X.ascii_key(F.col("artist"), F.col("name")).alias("match_key"),
        X.spotify_track(F.col("spotify_id")).alias("sp"),
    )
    by_key = single_owner(keyed, "match_key", "track_id")
    by_sp = single_owner(keyed, "sp", "track_id")
    reference = single_owner(canon, "lookup_key", "rec_id").withColumnRenamed("lookup_key", "match_key")
    by_rec = single_owner(by_key.join(reference, "match_key"), "rec_id", "track_id")
    combos = listens.groupBy(
        "msid", X.ascii_key(F.col("artist_name"), F.col("track_name")).alias("match_key"),
        F.coalesce(X.spotify_track(F.col("spotify_id")), X.spotify_track(F.col("spotify_uri"))).alias("sp"),
        X.spotify_format(F.col("spotify_id")).alias("fmt"),
    ).agg(F.count(F.lit(1)).alias("listens"))
    joined = lookup(combos, by_key.withColumnRenamed("track_id", "t_key"), "match_key", ["msid", "sp", "fmt"], combos)
    joined = lookup(joined, by_sp.withColumnRenamed("track_id", "t_sp"), "sp", ["msid", "match_key", "fmt"], combos)
    joined = lookup(joined, correspondence.select("msid", "rec_id"), "msid", ["sp", "match_key", "fmt"], combos)
    # most rows have no recording: lookup spreads their null key
    joined = lookup(joined, by_rec.withColumnRenamed("track_id", "t_rec"), "rec_id", ["msid", "sp", "match_key", "fmt"])
    route = (
        F.when(F.col("t_sp").isNotNull(), "spotify").when(F.col("t_rec").isNotNull(), "musicbrainz")
        .when(F.col("t_key").isNotNull(), "cle_artiste_titre")
    )
    return joined.withColumns({"track_id": F.coalesce("t_sp", "t_rec", "t_key"), "route": route})
