"""Registered queries against their SQL, and the pipeline against its stages' definitions."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.parity import compare, connect
from trackmetrics.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], connect(FOLDER)) == ""


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, docs, FOLDER), name)
        assert after.dtypes == spark.read.parquet(f"{FOLDER}/documents.parquet").dtypes
        kept[name] = {r["doc_id"]: r["text"] for r in after.select("doc_id", "text").collect()}
        docs = after
    sizes = [len(k) for k in kept.values()]
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    lines = [x for t in kept["line_filter"].values() for x in t.split("\n") if x.split()]
    assert len({tuple(x.encode().lower().split()) for x in lines}) == len(lines)
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == set(kept["benchmark_filter"])


def test_pipeline_stages_hand_small_batches_to_workers(spark):
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "10000")
        docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
        assert corpus_pipeline.pack_sequences(spark, docs, FOLDER).count() == 2
        assert int(spark.conf.get(conf)) <= 1_000
        spark.conf.set(conf, "10")
        corpus_pipeline.pack_sequences(spark, docs, FOLDER)
        assert spark.conf.get(conf) == "10"
    finally:
        spark.conf.set(conf, before)
