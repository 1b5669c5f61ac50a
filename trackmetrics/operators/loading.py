"""Batch loading: check the contract, write aside, verify what was written, publish, then register."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.operators import contract as CT
from trackmetrics.operators import quality as Q
from trackmetrics.operators.incremental import OLD, routing_errors
from trackmetrics.session import materialise
from trackmetrics.sources.layout import STAGING, delete_folders, has_partitions, partition_folder, partition_paths, publish, read_partitioned, resume_publication, write_rebalanced

LEDGER = "no int, start_s bigint, end_s bigint, announced bigint, n_rows bigint, recent bigint, old bigint, registered_s bigint, verdict string"


def parse_batch(lines: DataFrame, contract: CT.Contract) -> DataFrame:
    """Lines parsed and stored: loads of the same lines share them, if their contracts have the same fields (tolerances may differ)."""
    return materialise(CT.parse(lines, contract), "parsed")


def load_batch(
    lines: DataFrame,
    contract: CT.Contract,
    dump: str,
    reception: str,
    target: str,
    rejected: str,
    expected: int,
    control_only: bool = False,
    max_duplicates: float = 1.0,
    parsed: DataFrame | None = None,
) -> DataFrame:
    """Load one batch of raw lines all or nothing; one row with the outcome and the counts.

    The lines are parsed once and stored; ``parsed`` is what :func:`parse_batch` stored of the same lines before.  The contract decides on one row whether anything is written.  The batch
    is then written to a staging folder and checked there: routing, row count, and at most a share ``max_duplicates`` of repeats.
    Only a batch that passes is published, by renaming its partitions into the table; otherwise the table stays as it was, byte for byte.
    Reloading a batch replaces exactly its partitions.
    """
    spark = lines.sparkSession
    for path in (target, rejected):
        resume_publication(spark, path)
    parsed = parse_batch(lines, contract) if parsed is None else parsed
    decision = CT.batch_outcome(CT.measures(parsed), contract, expected).first()
    outcome, written, bad_routing = decision["outcome"], 0, 0
    if outcome == "ECRIRE" and control_only:
        outcome = "CONTROLE_OK"
    if outcome == "ECRIRE":
        staged = {path: f"{path.rstrip('/')}/{STAGING}-{uuid.uuid4().hex}" for path in (target, rejected)}
        write_rebalanced(CT.incremental_flat(parsed, dump, F.lit(reception).cast("date")), staged[target], _PARTS[0])
        check = routing_errors(read_partitioned(spark, staged[target]).withColumn("r", F.lit(reception).cast("date")), "r", "date").first()
        written = check["n"]
        bad_routing = check["recent_in_old"] + check["old_in_recent"] + check["wrong_day"]
        passed = bad_routing == 0 and 0 < written <= decision["kept"] and decision["kept"] - written <= max_duplicates * decision["kept"]
        outcome = "APLATI_OK" if passed else "APLATI_ECHEC"
        if passed:
            if decision["rejected"]:
                write_rebalanced(CT.rejects(parsed).withColumn("dump", F.lit(dump)), staged[rejected], _PARTS[1])
            for path, partitions in zip((target, rejected), _PARTS):
                _publish_batch(spark, staged[path], path, partitions, dump)
        else:
            delete_folders(spark, list(staged.values()))
    row = (dump, outcome, decision["n_read"], expected, decision["kept"], decision["rejected"], decision["private"], written,
           decision["kept"] - written if written else 0, bad_routing)
    return spark.createDataFrame([row], (
        "dump string, outcome string, n_read bigint, expected bigint, kept bigint, rejected bigint, private bigint, "
        "written bigint, duplicates bigint, bad_routing bigint"
    ))


def gated_write(df: DataFrame, path: str, partitions: Sequence[str], checks: Sequence[Q.Check]) -> DataFrame:
    """Write a partitioned table behind a gate that reads nothing twice; one row per check, ``published`` 0 or 1 on each.

    The metrics of the checks are observed on the rows as the last stage writes them to a staging folder, where a task that runs again is counted
    once.  If no blocking check fails, the partitions of ``df`` replace those of the table by rename;
    otherwise the staging folder goes and the table stays as it was.  Metrics must be plain aggregates: a distinct count
    cannot be observed and is refused by Spark.  Empty input writes nothing and is published as nothing, if the checks allow it.
    """
    spark = df.sparkSession
    resume_publication(spark, path)
    staging = f"{path.rstrip('/')}/{STAGING}-{uuid.uuid4().hex}"
    seen = Observation(f"gate-{uuid.uuid4().hex}")
    metrics = [column.alias(f"{check.name}.{m}") for check in checks for m, column in check.metrics.items()]
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions])
    balanced.observe(seen, *metrics).write.partitionBy(*partitions).parquet(staging)
    row = Row(*[Row(*[seen.get[f"{check.name}.{m}"] for m in check.metrics]) for check in checks])
    report = Q.judged(spark.createDataFrame([row], Q.measured(df, checks).schema), checks)
    refused = report.where((F.col("severity") == Q.BLOCK) & (F.col("ok") == 0)).count() > 0
    if refused:
        delete_folders(spark, [staging])
    else:
        publish(spark, staging, path, partition_paths(spark, staging, len(partitions)))
    return report.withColumn("published", F.lit(int(not refused)))


_PARTS = (["mois", "jour", "dump"], ["mois", "dump"])


def _publish_batch(spark: SparkSession, staging: str, path: str, partitions: list[str], dump: str) -> None:
    """Publish a staged batch and remove what an earlier load of it left in partitions that it no longer fills."""

    def names(folder: str) -> set[str]:  # partitions of one batch
        if not has_partitions(spark, folder):
            return set()
        found = read_partitioned(spark, folder).where(F.col("dump") == dump).select(*partitions).distinct().collect()
        return {partition_folder("", **{c: str(v) for c, v in r.asDict().items()}).lstrip("/") for r in found}

    filled = names(staging)
    stale = names(path) - filled
    if filled or stale:
        publish(spark, staging, path, filled, stale)


def register_batch(spark: SparkSession, ledger: str, no: int, bounds: tuple[int, int], report: DataFrame, target: str, now_s: int, verdict: str) -> None:
    """Append a ledger row, only for a successful load whose counts agree."""
    r = report.first()
    if r["outcome"] not in ("APLATI_OK", "DUMP_VIDE") or r["n_read"] != r["expected"]:
        raise ValueError(f"batch {no} is not registered: {r['outcome']}, {r['n_read']} read, {r['expected']} announced")
    recent = 0
    if r["written"]:
        stored = read_partitioned(spark, target).where(F.col("dump") == r["dump"])
        recent = stored.where(F.col("jour") != OLD).agg(n_rows()).first()[0]
    row = (no, *bounds, r["expected"], r["written"], recent, r["written"] - recent, now_s, verdict)
    spark.createDataFrame([row], LEDGER).write.mode("append").parquet(ledger)
