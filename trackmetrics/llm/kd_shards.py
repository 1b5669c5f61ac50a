"""Shards by a k-d tree over document metadata, in DataFrame operations only.

All nodes of a level are split at once.  A node that must still make n leaves is cut
along its widest dimension where the lower side reaches floor(n/2)/n of its bytes: a weighted median,
found by histograms of at most ``BINS`` bins per node that zoom in on the bin holding the cut.
Keys are 62-bit integers, the dimension's value above and a hash of the text below, so equal values split too.

Equal texts form a group that stands where its row of smallest doc_id stands, so a cut passes beside it.  Only when that
would leave a side off its bytes by more than ``TOLERANCE`` of a leaf per leaf does the cut go through the group, along a hash of
its rows: at most one group per cut, so at most leaves - 1 of all groups lie in several shards.

Rows of equal doc_id and text are counted, not numbered, and dealt in portions, so the shards of a table do
not depend on its files or partitions.  Only one row per node (at most one per leaf) comes to the driver.

Null texts have no bytes (size 16) and form one group, null metadata counts as the lowest value,
repeated rows are placed one by one, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackmetrics.functions.staging import compute_once
from trackmetrics.llm.common import numbered
from trackmetrics.operators.skew import attach
from trackmetrics.session import materialise

BINS = 2048
ROW_BYTES = 16
TOLERANCE = 0.005  # share of a leaf by which a cut may miss its aim, per leaf of a side, to keep a group whole
PORTIONS = 1000  # portions of a leaf into which copies of one row are dealt
MAX_COPIES = 1 << 20  # copies in a portion
_HALF = 1 << 31


def default_dimensions() -> dict[str, Column]:
    """Source, language, length and age of a document, each as a double."""

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(_HALF)).cast("double")

    return {
        "source": place("source"), "lang": place("lang"),
        "length": F.log2(F.col("__size").cast("double")), "age": F.col("doc_id").cast("double"),
    }


def _scaled(df: DataFrame, ranges: DataFrame, dims: list[str]) -> DataFrame:
    """Each dimension as an integer from 0 to 2^31 - 1 over its range in ``ranges``."""
    ends = ranges.agg(*[f(d).alias(f"{d}_{n}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = df
    for d in dims:
        lo, hi = ends[f"{d}_lo"], ends[f"{d}_hi"]
        span = (hi - lo) if lo is not None and hi > lo else 1.0
        out = out.withColumn(d, F.coalesce(((F.col(d) - F.lit(lo or 0.0)) / F.lit(span) * F.lit(_HALF - 1)).cast("long"), F.lit(0)))
    return out


def _pick(values: Mapping[int, object], otherwise: object, kind: str) -> Column:
    """A column with the value of the row's node."""
    if not values:
        return F.lit(otherwise).cast(kind)
    pairs = [F.lit(x) for k, v in values.items() for x in (int(k), v)]
    return F.coalesce(F.create_map(*pairs)[F.col("node")], F.lit(otherwise)).cast(kind)


def assign(
    docs: DataFrame,
    target_bytes: int | None = None,
    leaves: int | None = None,
    dimensions: Mapping[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard (0 to leaves - 1), slot (gapless from 0 within the shard).

    Give ``leaves``, or ``target_bytes`` for as many leaves as the bytes need.
    Every cut is exact up to one document, ``TOLERANCE`` or one ten-thousandth of its node, so leaves differ by a
    small multiple of the largest document or some hundredths.
    """
    # Columns that share a name with the working columns would clash: only the dimensions' inputs are read.
    text = F.col(text_col).cast("string")
    sized = docs.withColumn("__size", (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long"))
    dims = dict(dimensions or default_dimensions())
    names = [f"d{i}" for i in range(len(dims))]
    rows = sized.select(
        F.col(id_col).alias("doc_id"),
        F.col("__size").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("same"),
        *[c.alias(n) for n, c in zip(names, dims.values())],
    )
    place = F.struct(*names)
    units = rows.groupBy("doc_id", "size", "text_crc32", "same").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("place"))
    units = materialise(units.select("doc_id", "size", "text_crc32", "same", "copies", "place.*"), "sized")
    total = units.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0
    leaves = leaves or max(1, math.ceil(total / (target_bytes or max(total, 1))))
    rows = _scaled(_placed_by_group(units, names), units, names)
    rows = materialise(_portions(rows, max(total // (leaves * PORTIONS), 1)).withColumn("node", F.lit(0)), "scaled")
    # node number = first shard below it; `open` holds how many leaves a node must still make
    open_nodes = {0: leaves}
    while open_nodes := {k: n for k, n in open_nodes.items() if n > 1}:
        cut = _cut_level(rows, names, open_nodes)
        rows = materialise(_route(rows, cut), "level")  # a few numbers per row; keeps the plan of the next level flat
        open_nodes = {k2: n2 for k, n in open_nodes.items() for k2, n2 in ((k, n // 2), (k + n // 2, n - n // 2))}
    alike = ["doc_id", "same", "part", "copy"]
    placed = rows.select(
        "doc_id", "size", "text_crc32", F.col("node").alias("shard"), "same", "part", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")
    )
    return numbered(placed, ["shard"], [F.col(c) for c in alike], "slot", alike).drop("same", "part", "copy")


def _placed_by_group(units: DataFrame, names: list[str]) -> DataFrame:
    """Units of one text all get the metadata of the one with the smallest doc_id."""
    first = F.min(F.struct("doc_id", *names)).alias("__first")
    groups = units.groupBy("same").agg(F.count(F.lit(1)).alias("__units"), first).where("__units > 1")
    joined = attach(units, groups, ["same"], "__units", ["doc_id"])
    inside = F.col("__first").isNotNull()
    return joined.select(
        *[c for c in units.columns if c not in names],
        *[F.when(inside, F.col(f"__first.{n}")).otherwise(F.col(n)).alias(n) for n in names],
    )


def _portions(units: DataFrame, portion_bytes: int) -> DataFrame:
    """Each unit's ``copies`` equal rows as portions (part, n) of about ``portion_bytes`` at most."""
    per = F.greatest(F.lit(1), F.least(F.lit(MAX_COPIES), F.floor(F.lit(portion_bytes) / F.col("size")))).cast("long")
    dealt = units.withColumn("__per", per)
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.col("__per")))))
    return dealt.withColumn("n", F.least(F.col("__per"), F.col("copies") - F.col("part") * F.col("__per"))).drop("__per", "copies")


def _key(axis: Mapping[int, int], names: list[str]) -> Column:
    """The row's key along the axis of its node: value above, hash of the text below."""
    value = F.lit(0).cast("long")
    for i, name in enumerate(names):
        nodes = [k for k, a in axis.items() if a == i]
        if nodes:
            value = F.when(F.col("node").isin(nodes), F.col(name)).otherwise(value)
    return value * _HALF + F.pmod(F.xxhash64("same"), F.lit(_HALF))


def _within() -> Column:
    """The row's place inside its group."""
    return F.pmod(F.xxhash64("doc_id", "same", "part"), F.lit(_HALF * _HALF))


def _cut_level(rows: DataFrame, names: list[str], open_nodes: dict[int, int]) -> dict:
    """For each open node the axis, the (key, place inside a group) from which rows go to the upper side, and that side's number."""
    inside = rows.where(F.col("node").isin(list(open_nodes)))
    weight = F.col("size") * F.col("n")
    stats = inside.groupBy("node").agg(F.sum(weight).alias("bytes"), *[f(n).alias(f"{n}_{k}") for n in names for k, f in (("lo", F.min), ("hi", F.max))]).collect()
    axis = {r["node"]: max(range(len(names)), key=lambda i: r[f"{names[i]}_hi"] - r[f"{names[i]}_lo"]) for r in stats}
    aim = {r["node"]: r["bytes"] * (open_nodes[r["node"]] // 2) / open_nodes[r["node"]] for r in stats}
    whole = {r["node"]: r["bytes"] for r in stats}
    spare = {k: TOLERANCE * whole[k] / open_nodes[k] * (open_nodes[k] // 2) for k in axis}
    lo = {r["node"]: r[f"{names[axis[r['node']]]}_lo"] * _HALF for r in stats}
    hi = {r["node"]: (r[f"{names[axis[r['node']]]}_hi"] + 1) * _HALF - 1 for r in stats}
    below = dict.fromkeys(axis, 0)  # bytes of the node under lo
    split: dict[int, int] = {}  # key of the group that the cut goes through
    at: dict[int, tuple[int, int]] = {}
    keyed = compute_once(inside.select("node", weight.alias("weight"), "doc_id", "same", "part", *names), key=_key(axis, names), within=_within())
    while todo := [k for k in axis if k not in at]:
        low, width = _pick({k: lo[k] for k in todo}, 0, "long"), _pick({k: (hi[k] - lo[k]) // BINS + 1 for k in todo}, 1, "long")
        high, group = _pick({k: hi[k] for k in todo}, 0, "long"), _pick(split, -1, "long")
        along = F.when(group < 0, F.col("key")).when(F.col("key") == group, F.col("within"))
        zone = keyed.where(F.col("node").isin(todo)).withColumn("along", along).where((F.col("along") >= low) & (F.col("along") <= high))
        bins = zone.groupBy("node", ((F.col("along") - low) / width).cast("long").alias("bin")).agg(
            F.sum("weight").alias("b"), F.count(F.lit(1)).alias("n"), F.min("along").alias("first"), F.max("along").alias("last")
        )
        upto = F.sum("b").over(Window.partitionBy("node").orderBy("bin")) + _pick({k: below[k] for k in todo}, 0, "long")
        reached = bins.withColumn("upto", upto).where(F.col("upto") >= _pick({k: aim[k] for k in todo}, 0.0, "double"))
        for r in reached.groupBy("node").agg(F.min(F.struct("bin", "upto", "b", "n", "first", "last")).alias("r")).select("node", "r.*").collect():
            k, under = r["node"], r["upto"] - r["b"]
            off = min(r["upto"] - aim[k], aim[k] - under)
            one_key = r["first"] == r["last"]
            if r["n"] == 1 or r["b"] <= whole[k] * 1e-4 or (one_key and (k in split or off <= spare[k])):
                edge = r["last"] + 1 if r["upto"] - aim[k] <= aim[k] - under else r["first"]
                at[k] = (split[k], edge) if k in split else (edge, 0)
            elif one_key:
                split[k], below[k], lo[k], hi[k] = r["first"], under, 0, _HALF * _HALF - 1
            else:
                below[k], lo[k], hi[k] = under, r["first"], r["last"]
    return {"axis": axis, "at": at, "upper": {k: k + open_nodes[k] // 2 for k in axis}, "names": names}


def _route(rows: DataFrame, cut: dict) -> DataFrame:
    key, place = (_pick({k: at[i] for k, at in cut["at"].items()}, 0, "long") for i in (0, 1))
    own = _key(cut["axis"], cut["names"])
    goes_up = F.col("node").isin(list(cut["axis"])) & ((own > key) | ((own == key) & (_within() >= place)))
    return rows.withColumn("node", F.when(goes_up, _pick(cut["upper"], 0, "int")).otherwise(F.col("node")))
