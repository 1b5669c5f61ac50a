"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; every stage but the last returns the
columns it was given.  Documents that share a doc_id stay or go together; documents with a null doc_id are never
taken for a duplicate or contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmetrics.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from trackmetrics.llm.common import broadcast_if_small
from trackmetrics.llm.queries import on_workers, vocabulary
from trackmetrics.session import materialise

#: Encoded pieces a worker keeps: after four stages the executors have grown, so fewer than where encoding runs alone.
TABLE_PIECES = 150_000
#: Rows handed to a Python worker at a time: a batch of texts or shingle sets stands in the executor, in the worker and in its results.
BATCH_ROWS = 1_000


def _on_workers(spark: SparkSession) -> None:
    on_workers(spark)
    if int(spark.conf.get(_BATCH_CONF)) > BATCH_ROWS:  # a session with smaller batches keeps them
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose doc_id is not in ``ids`` (a list of rejected ones, far fewer than the documents)."""
    return docs.join(broadcast_if_small(ids.select("doc_id").distinct()), "doc_id", "left_anti").select(docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not reject and that are not abusive."""
    _on_workers(spark)
    return quality.classify(docs, with_text=True).where("keep AND NOT toxic").select(docs.columns)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier; documents that lose their last word this way go, n_chars follows the text."""
    _on_workers(spark)
    cleaned = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_exact") + F.col("n_near") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cleaned = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    return cleaned.select([F.char_length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest doc_id, of each group linked by equal or similar shingle sets."""
    _on_workers(spark)
    groups = materialise(jaccard_join.similar_sets(docs), "groups")
    return _without(docs, groups.where("component_id <> doc_id"))


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    _on_workers(spark)
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, materialise(found.where("contaminated").select("doc_id"), "contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    _on_workers(spark)
    return packing.pack(docs, vocabulary(), table_pieces=TABLE_PIECES)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_filter", line_filter),
    ("near_duplicate_filter", near_duplicate_filter),
    ("benchmark_filter", benchmark_filter),
    ("pack_sequences", pack_sequences),
]

#: No SQL trains the classifier or encodes texts; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
