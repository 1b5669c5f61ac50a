"""Digest tree over day x title tables: where two tables differ, found from the root down.

A leaf is the order-free digest of the rows of one day whose title falls in one bucket; a node above adds up the
hashes of its children's places and digests.  The whole tree is one aggregate over the rows and three over its own small tables, and it is
stored beside the table it describes.  Comparing two trees descends only below nodes that differ, so only
the rows of differing days are read afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.functions.counting import n_rows
from trackmetrics.session import materialise

PLACE = ["mois", "date", "bucket"]
BUCKETS = 64


def _added(*parts: str | Column) -> Column:
    return F.sum(F.xxhash64(*parts).cast("decimal(38,0)")).cast("string")


def digest_tree(table: DataFrame, title: str, values: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Nodes (level, mois, date, bucket, n, digest): level 3 a bucket of a day, 2 a day, 1 a month, 0 the root.  Nulls differ from every value."""
    told = [x for c in (title, *values) for x in (F.col(c).isNull(), F.col(c))]
    nodes = table.groupBy("mois", F.col("date").cast("string").alias("date"), F.pmod(F.xxhash64(title), F.lit(buckets)).cast("int").alias("bucket")).agg(
        n_rows().alias("n"), _added(*told).alias("digest")
    )
    levels = [nodes.select(F.lit(3).alias("level"), *PLACE, "n", "digest")]
    for level in (2, 1, 0):
        kept, gone = PLACE[:level], PLACE[level]
        nodes = nodes.groupBy(*kept).agg(F.sum("n").alias("n"), _added(gone, "n", "digest").alias("digest"))
        absent = [F.lit(None).cast("int" if c == "bucket" else "string").alias(c) for c in PLACE[level:]]
        levels.append(nodes.select(F.lit(level).alias("level"), *kept, *absent, "n", "digest"))
    return materialise(reduce(DataFrame.unionByName, levels), "digest_tree")


def differing(left: DataFrame, right: DataFrame, level: int) -> DataFrame:
    """Nodes of a level (their place, left_n and right_n, null where absent) that differ; only children of differing nodes are compared."""
    found = None
    for step in range(level + 1):
        keys = PLACE[:step]
        sides = []
        for tree, name in ((left, "left"), (right, "right")):
            part = tree.where(F.col("level") == step)
            if found is not None and step > 1:
                part = part.join(found.select(*PLACE[: step - 1]), PLACE[: step - 1], "left_semi")
            sides.append(part.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.col("n").alias(f"{name}_n"), F.col("digest").alias(f"{name}_digest")))
        same = reduce(lambda a, b: a & b, [F.col(f"left_{k}").eqNullSafe(F.col(f"right_{k}")) for k in keys], F.lit(True))
        joined = sides[0].join(sides[1], same, "full_outer") if keys else sides[0].crossJoin(sides[1])  # the root: one row a side
        changed = joined.where(~(F.col("left_digest").eqNullSafe(F.col("right_digest")) & F.col("left_n").eqNullSafe(F.col("right_n"))))
        found = materialise(changed.select(*[F.coalesce(f"left_{k}", f"right_{k}").alias(k) for k in keys], "left_n", "right_n"), "differing")
        if not found.head(1):
            break
    return found if step == level else found.select(*[F.lit(None).cast("int" if k == "bucket" else "string").alias(k) for k in PLACE[:level]], "left_n", "right_n")


def changed_rows(left: DataFrame, right: DataFrame, days: DataFrame, title: str, values: Sequence[str]) -> DataFrame:
    """Rows (date, title, kind) that differ on the given days (mois, date); both tables are read for the months and days named only.

    The names of the days pass through the driver, so that scans are pruned by literals; the calendar bounds them.
    """
    names = days.select("mois", "date").distinct().collect()
    wanted = F.col("mois").isin(sorted({r["mois"] for r in names})) & F.col("date").cast("string").isin(sorted({r["date"] for r in names}))
    old, new = (t.where(wanted).select(F.col("date").cast("string").alias("date"), F.col(title).alias("title"), F.struct(*values).alias(name)) for t, name in ((left, "old"), (right, "new")))
    joined = old.join(new, ["date", "title"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    kind = F.when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "added").otherwise("changed")
    return joined.select("date", F.col("title").alias(title), kind.alias("kind"))
