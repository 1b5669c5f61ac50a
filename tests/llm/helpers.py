"""Small tables with awkward rows, and brute-force versions of the operators."""

import pyarrow as pa  # noqa: F401
import public_tokenizers
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
BASE = "The quick brown fox jumps over the lazy dog while seven wizards quietly box up five dozen liquor jugs for the party tonight"
ROWS = [
    (0, BASE),
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, BASE),
    (5, BASE.replace("lazy", "sleepy") + "\n" + BASE),
    (6, "one"),
    (7, "one two three"),
    (8, "É É é ÀB cd\n" + BASE.upper()),
    (9, LONG),
    (10, LONG + " tail"),
    (11, "a  b   c \n\n d <|endoftext|> e"),
    (12, BASE + " extra words follow here"),
    (12, BASE + " extra words follow here"),
    (None, "A row without an id has a text of its own, longer than thirteen words so that it may count."),
]


def docs(spark, rows=ROWS):
    """Documents with null metadata and extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = {c: F.lit("x") for c in ("rid", "node", "n", "h", "words", "start", "kind", "label", "key", "score", "keep", "near", "kept", "size", "pos", "shard", "n_lines")}
    return df.withColumns({"lang": F.lit(None).cast("string"), "source": F.when(F.col("doc_id") > 3, F.lit("s")), **clash}).repartition(3)


def empty(spark):
    return docs(spark).where("doc_id < -1")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
