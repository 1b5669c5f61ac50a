"""Quality gates as data: checks are rows, the verdict is an aggregate of them.

A :class:`Check` names the aggregates it needs and a test over them.  All checks
of one table run in a single aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.functions import text as X
from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators.catalog import AUDIO, BOUNDS
from trackmetrics.operators.incremental import volume_anomalies

BLOCK, WARN = "BLOQUANT", "AVERTISSEMENT"


@dataclass(frozen=True)
class Check:
    name: str
    category: str
    severity: str
    expected: str
    metrics: Mapping[str, Column]
    ok: Column

    def row(self) -> Column:
        observed = F.concat_ws(", ", *[
            F.concat(F.lit(f"{m}="), F.coalesce(F.col(f"{self.name}.{m}").cast("string"), F.lit("null"))) for m in self.metrics
        ])
        return F.struct(
            F.lit(self.name).alias("check"), F.lit(self.category).alias("category"), F.lit(self.severity).alias("severity"),
            F.lit(self.expected).alias("expected"), observed.alias("observed"), F.coalesce(self.ok, F.lit(False)).cast("int").alias("ok"),
        )


def run(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate the checks of one table: one aggregate, one row per check."""
    return judged(measured(df, checks), checks)


def measured(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with a struct of metrics per check."""
    return df.agg(*[F.struct(*[c.alias(m) for m, c in check.metrics.items()]).alias(check.name) for check in checks])


def judged(metrics: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check from the row of :func:`measured`."""
    return metrics.select(F.inline(F.array(*[c.row() for c in checks])))


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verdict(checks: DataFrame) -> DataFrame:
    """Summary of a gate; any failed blocking check makes it ``ECHEC``."""
    failed = F.col("ok") == 0
    blocking = F.count_if(failed & (F.col("severity") == BLOCK))
    return checks.agg(
        n_rows().alias("checks"), F.count_if(~failed).alias("passed"), blocking.alias("blocking_failures"),
        F.count_if(failed & (F.col("severity") == WARN)).alias("warnings"),
        F.when(blocking > 0, "ECHEC").otherwise("SUCCES").alias("status"),
    )


# -- catalogue and history ----------------------------------------------------------


def catalog_checks(min_rows: int = 50_000, key: str = "track_id", genre_pct: float = 60.0) -> dict[str, Check]:
    m = lambda check, name: F.col(f"{check}.{name}")
    null_pct = lambda c: F.round(F.avg(F.col(c).isNull().cast("double")) * 100, 3)
    return {
        "dq1": Check("dq1", "volume", BLOCK, f">= {min_rows} rows", {"n": n_rows()}, m("dq1", "n") >= min_rows),
        "dq2": Check("dq2", "integrity", BLOCK, "no duplicate, no null", {
            "duplicates": n_rows() - F.count_distinct(key), "nulls": F.count_if(F.col(key).isNull()),
        }, (m("dq2", "duplicates") == 0) & (m("dq2", "nulls") == 0)),
        "dq3": Check("dq3", "completeness", BLOCK, "0 null audio values", {
            "nulls": sum((F.count_if(F.col(c).isNull()) for c in AUDIO), F.lit(0)),
        }, m("dq3", "nulls") == 0),
        "dq4": Check("dq4", "plausibility", BLOCK, "documented bounds", {
            "out_of_bounds": sum((F.count_if((F.col(c) < lo) | (F.col(c) > hi)) for c, (lo, hi) in BOUNDS.items()), F.lit(0)),
        }, m("dq4", "out_of_bounds") == 0),
        "dq5": Check("dq5", "completeness", WARN, f"<= {genre_pct} %", {"null_pct": null_pct("genre")}, m("dq5", "null_pct") <= genre_pct),
        "dq6": Check("dq6", "completeness", WARN, "reported", {"null_pct": null_pct("year")}, F.lit(True)),
    }


def history_checks(min_rows: int = 9_600_000, token: str = "user_tok", length: int = 32) -> dict[str, Check]:
    m = lambda check, name: F.col(f"{check}.{name}")
    return {
        "dq8": Check("dq8", "volume", BLOCK, f">= {min_rows} rows", {"n": n_rows()}, m("dq8", "n") >= min_rows),
        "dq9": Check("dq9", "privacy", BLOCK, f"{length} hex characters, no null", {
            "shortest": F.min(F.length(token)), "longest": F.max(F.length(token)),
            "not_hex": F.count_if(~F.col(token).rlike("^[0-9a-f]+$")), "nulls": F.count_if(F.col(token).isNull()),
        }, (m("dq9", "shortest") == length) & (m("dq9", "longest") == length) & (m("dq9", "not_hex") == 0) & (m("dq9", "nulls") == 0)),
        "dq10": Check("dq10", "plausibility", BLOCK, ">= 1", {
            "lowest": F.min("playcount"), "not_positive": F.count_if(F.col("playcount") <= 0),
        }, m("dq10", "not_positive") == 0),
    }


def no_identifier(df: DataFrame, forbidden: Sequence[str] = ("user_id", "userid", "user", "email", "ip")) -> DataFrame:
    """No direct identifier among the columns; the rows are counted to tie the result to the data."""
    found = sorted(set(df.columns) & set(forbidden))
    check = Check("dq7", "privacy", BLOCK, "no identifying column", {"n": n_rows(), "found": F.lit(",".join(found))}, F.lit(not found))
    return run(df, [check])


def composite_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    groups = df.groupBy(*keys).agg(n_rows().alias("n"))
    check = Check("dq11", "integrity", BLOCK, "0 duplicate", {"duplicates": F.count_if(F.col("n") > 1)}, F.col("dq11.duplicates") == 0)
    return run(groups, [check])


def referential(rows: DataFrame, reference: DataFrame, key: str, coverage_pct: float = 55.0) -> DataFrame:
    """Orphan keys and coverage of the reference, from one grouping of each side by key."""
    sides = rows.groupBy(key).agg(F.lit(1).alias("used"), F.lit(0).alias("known")).unionByName(
        reference.groupBy(key).agg(F.lit(0).alias("used"), F.lit(1).alias("known"))
    ).groupBy(key).agg(F.max("used").alias("used"), F.max("known").alias("known"))
    used, known = F.col("used") == 1, F.col("known") == 1
    pct = F.round(F.try_divide(F.lit(100.0) * F.count_if(used), F.count_if(known)), 2)
    return run(sides, [
        Check("dq12", "integrity", BLOCK, "0 orphan", {"orphans": F.count_if(used & ~known), "keys": F.count_if(used)}, F.col("dq12.orphans") == 0),
        Check("dq13", "coverage", WARN, f">= {coverage_pct} %", {"pct": pct}, F.col("dq13.pct") >= coverage_pct),
    ])


# -- raw JSON, flattened listens, volumes ---------------------------------------------


def raw_key_checks(lines: DataFrame, contract: CT.Contract) -> DataFrame:
    """Keys outside the contract and forbidden keys; an empty batch proves nothing and fails."""
    counted = CT.unknown_key_totals(lines, contract).withColumn(
        "policy", F.when(F.col("key").isNotNull(), CT.key_policy(contract, F.col("key")))
    )
    total = F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0))
    return run(counted, [
        Check("dq14", "raw_json", BLOCK, "0 key outside the contract", {"keys": F.count_if(F.col("policy") == "nouvelle"), "n_lines": total},
              (F.col("dq14.keys") == 0) & (F.col("dq14.n_lines") > 0)),
        Check("dq16", "raw_json", BLOCK, "0 forbidden or purged key", {"keys": F.count_if(F.col("policy") == "interdite"), "n_lines": total},
              (F.col("dq16.keys") == 0) & (F.col("dq16.n_lines") > 0)),
    ])


def removed_at_ingestion(counts: DataFrame) -> DataFrame:
    """Unknown keys that the minimisation removed, from its counters (family, key, n)."""
    unknown = F.col("family") == "nouvelle"
    return run(counts, [Check("dq15", "raw_json", WARN, "0 unknown key removed", {
        "keys": F.count_if(unknown), "occurrences": F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)),
    }, F.col("dq15.keys") == 0)])


def exact_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing, extra = sorted(set(expected) - set(df.columns)), sorted(set(df.columns) - set(expected))
    check = Check("dq17", "flat", BLOCK, f"exactly {len(expected)} columns", {
        "n": n_rows(), "missing": F.lit(",".join(missing)), "extra": F.lit(",".join(extra)),
    }, F.lit(not missing and not extra))
    return run(df, [check])


def flat_coherence(df: DataFrame, token: str, seconds: str, day: str, month: str) -> DataFrame:
    return run(df, [coherence_check(token, seconds, day, month)])


def coherence_check(token: str, seconds: str, day: str, month: str) -> Check:
    col = F.col
    return Check("dq18", "flat", BLOCK, "tokens and dates coherent", {
        "n": n_rows(), "bad_tokens": F.count_if(~F.coalesce(col(token), F.lit("")).rlike(X.HEX32)),
        "bad_dates": F.count_if(X.day_of(col(seconds)) != col(day)), "bad_months": F.count_if(X.month_of(col(day)) != col(month)),
        "nulls": F.count_if(col(seconds).isNull() | col(day).isNull()),
    }, (col("dq18.n") > 0) & (col("dq18.bad_tokens") == 0) & (col("dq18.bad_dates") == 0) & (col("dq18.bad_months") == 0) & (col("dq18.nulls") == 0))


def volume_check(name: str, series: DataFrame, lot: str, n: str, window: int, high: float, low: float, history: int = 6) -> DataFrame:
    """Number of lots out of bounds; an empty series fails."""
    anomalies = volume_anomalies(series, lot, n, window, high, low, history)
    lots = series.agg(n_rows()).scalar()
    out = anomalies.agg(n_rows().alias("out")).select("out", lots.alias("lots"))
    return run(out, [Check(name, "volume", WARN, f"ratio in [{low}, {high}]", {"lots": F.max("lots"), "out": F.max("out")},
                           (F.col(f"{name}.lots") > 0) & (F.col(f"{name}.out") == 0))])


# -- references, tags, publication --------------------------------------------------------


def reference_keys(canon: DataFrame, redirect: DataFrame, key: str) -> DataFrame:
    """Unique UUID keys in both reference tables."""
    tagged = canon.select(key, F.lit("c").alias("t")).unionByName(redirect.select(key, F.lit("r").alias("t")))
    per_key = tagged.groupBy("t", key).agg(n_rows().alias("n"))
    canonical = F.col("t") == "c"
    bad = ~F.coalesce(F.col(key), F.lit("")).rlike(X.UUID)
    return run(per_key, [Check("dq21", "reference", BLOCK, "unique UUID keys", {
        "canon": F.coalesce(F.sum(F.when(canonical, F.col("n"))), F.lit(0)), "redirect": F.coalesce(F.sum(F.when(~canonical, F.col("n"))), F.lit(0)),
        "duplicates": F.sum(F.col("n") - 1), "not_uuid": F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)),
    }, (F.col("dq21.canon") > 0) & (F.col("dq21.redirect") > 0) & (F.col("dq21.duplicates") == 0) & (F.col("dq21.not_uuid") == 0))])


def correspondence(corr: DataFrame, canon: DataFrame) -> DataFrame:
    """One row per msid, recordings all in the reference, share in ]0, 1]."""
    outside = corr.groupBy("rec_id").agg(n_rows().alias("n")).join(canon.select("rec_id"), "rec_id", "left_anti")
    n_outside = outside.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    share = F.col("share")
    tested = corr.agg(
        n_rows().alias("n"), F.count_distinct("msid").alias("d"), F.count_if(share.isNull() | (share <= 0) | (share > 1)).alias("bad"),
    ).select("n", (F.col("n") - F.col("d")).alias("dup"), "bad", n_outside.alias("outside"))
    return run(tested, [Check("dq22", "reference", BLOCK, "msid unique, in reference, share in ]0,1]", {
        "n": F.max("n"), "duplicates": F.max("dup"), "outside": F.max("outside"), "bad_share": F.max("bad"),
    }, (F.col("dq22.n") > 0) & (F.col("dq22.duplicates") == 0) & (F.col("dq22.outside") == 0) & (F.col("dq22.bad_share") == 0))])


def vocabulary(vocab: DataFrame, per_item: DataFrame, minimum: int) -> DataFrame:
    per_tag = per_item.groupBy("tag").agg(n_rows().alias("n"))
    outside = per_tag.join(vocab.select("tag"), "tag", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    tested = vocab.agg(n_rows().alias("n"), F.count_distinct("tag").alias("d"), F.count_if(F.col("items") < minimum).alias("under"))
    tested = tested.select("n", (F.col("n") - F.col("d")).alias("dup"), "under", outside.alias("outside"))
    return run(tested, [Check("dq24", "tags", BLOCK, f"unique, >= {minimum} items, no tag outside", {
        "n": F.max("n"), "duplicates": F.max("dup"), "under": F.max("under"), "outside": F.max("outside"),
    }, (F.col("dq24.n") > 0) & (F.col("dq24.duplicates") == 0) & (F.col("dq24.under") == 0) & (F.col("dq24.outside") == 0))])


def publication(df: DataFrame, listeners: str, k: int) -> DataFrame:
    """No published row under k listeners; a null count is under k."""
    under = F.count_if(F.coalesce(F.col(listeners), F.lit(0)) < k)
    return run(df, [Check("dq25", "publication", BLOCK, f"0 row under {k}", {"n": n_rows(), "under": under},
                          (F.col("dq25.n") > 0) & (F.col("dq25.under") == 0))])


def expected_values(df: DataFrame, wanted: Mapping[str, tuple[Column, Column | int]]) -> DataFrame:
    """Compare measured aggregates with expected values: one check per name."""
    checks = []
    for name, (metric, want) in wanted.items():
        want = want if isinstance(want, Column) else F.lit(want)
        checks.append(Check(name, "expected", BLOCK, name, {"measured": metric}, F.col(f"{name}.measured") == want))
    return run(df, checks)


def replication(source: DataFrame, copied: DataFrame, user: str, factor: int) -> DataFrame:
    """Rows and users of the copy are ``factor`` times those of the source."""
    base = source.agg(F.struct(n_rows().alias("n"), F.count_distinct(user).alias("u"))).scalar()
    return run(copied, [Check("dq27", "replication", BLOCK, f"x {factor}", {"n": n_rows(), "users": F.count_distinct(user)},
                              (F.col("dq27.n") == base.getField("n") * factor) & (F.col("dq27.users") == base.getField("u") * factor))])


def calendar(days: DataFrame, first: Column, last: Column) -> DataFrame:
    return run(days, [Check("dq28", "calendar", BLOCK, "one row per day, ISO weekday", {
        "n": n_rows(), "first": F.min("date"), "last": F.max("date"), "bad_weekday": F.count_if(~F.col("weekday").between(1, 7)),
    }, (F.col("dq28.first") == first) & (F.col("dq28.last") == last) & (F.col("dq28.n") == F.datediff(last, first) + 1)
       & (F.col("dq28.bad_weekday") == 0))])
