"""The registered queries of this package and their SQL."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from trackmetrics.llm import decontaminate, embedding_dedup, jaccard_join, kd_shards, line_dedup, packing, periodic_runs, pii, quality, repeats, source_audit, token_store, vp_trees

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Vocabulary file of the token operators; a path, so that another vocabulary can be named.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def on_workers(spark: SparkSession) -> None:
    """Send the package to Python workers that would not find it: neither the work folder nor PYTHONPATH holds it."""
    root = Path(__file__).resolve().parents[2]
    found = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    if root in [p.resolve() for p in found] or spark.sparkContext.applicationId in _sent:
        return
    archive = Path(tempfile.mkdtemp(prefix="trackmetrics-")) / "trackmetrics.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in (root / "trackmetrics").rglob("*.py"):
            out.write(path, path.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _sent.add(spark.sparkContext.applicationId)


_sent: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_exact", "n_near", "text")


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


@query("op4_token_store")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.tokenise_to_files(table(spark, sf_dir, "documents"), vocabulary()).select("doc_id", "start", "n_tokens", "ids_crc32", "file")


@query("op5_kd_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.assign(table(spark, sf_dir, "documents"), leaves=40).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' AS law", "shard", "slot", "CAST(NULL AS INT) AS grown_shard"
    )


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""


@query(
    "op10_contamination",
    f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len, array_to_string(w[s:s + len - 1], ' ') AS win FROM (
    SELECT item_id, w, least(13, len(w)) AS len, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, l.len, s.s, array_to_string(w[s.s:s.s + l.len - 1], ' ') AS win
    FROM d, (SELECT DISTINCT len FROM bw) l, LATERAL (SELECT unnest(generate_series(1, len(w) - l.len + 1)) AS s) s),
occ AS (SELECT doc_id, s, dw.len, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.len = bw.len),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + len - 1)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


_COMPONENTS = """
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
comp AS (SELECT a, min(least(a, b)) AS component_id FROM reach GROUP BY a)
"""


@query(
    "op8_jaccard_join",
    f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g FROM
    (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.a = d.doc_id
""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_sets(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query(
    "op2_embedding_dedup",
    f"""
WITH RECURSIVE u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT * FROM u WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{_COMPONENTS},
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Key of the test tables' surrogates; a real run passes its own secret.
PII_KEY = b"surrogates of the test tables"


@query("op6_pii_surrogates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


@query("op7_repeated_strings")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("starts", "stops")


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), change=periodic_runs.with_repetition)
    return periodic_runs.summarised(found)


@query(
    "op12_source_audit",
    r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(total) AS nl FROM k GROUP BY lang),
ng AS (SELECT lang, source, sum(n) AS ng FROM c GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, CAST(1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (coalesce(ng, 0) + 2 * v) AS BIGINT) AS p,
        CAST(1 + 1000000000::HUGEINT * (total + 2) // (nl + 2 * v) AS BIGINT) AS q
    FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN ng USING (lang, source) LEFT JOIN c USING (lang, source, term)),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"))


@query(
    "op13_nearest_neighbours",
    """
WITH u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT * FROM u WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
z AS (SELECT a.vec_id AS query_id, b.vec_id, list_zip(a.v, b.v) AS z FROM ok a JOIN ok b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
d AS (SELECT query_id, vec_id, sqrt(list_reduce(list_transform(z, lambda c: (c[1] - c[2]) * (c[1] - c[2])), lambda x, y: x + y)) AS score FROM z),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_trees.nearest(table(spark, sf_dir, "embeddings"))
