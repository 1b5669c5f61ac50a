"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Vectors with equal label and length are compared.  Equal vectors are one class with a
multiplicity.  Each (label, length) is cut into cells by spherical k-means, fitted on a bounded sample; every vector goes to
its nearest centroid.  Two vectors at the threshold are at most d = sqrt(2 - 2 t) apart on the sphere, so a partner of y in a cell with
a lower number than y's own exists only if y is within d of the plane between the two centroids: y then visits that cell, and
every link is found once, whatever the cells are.  Large cells are cut into blocks; each pair of blocks is one unit of work.

Null labels, null or empty vectors, zero vectors and vectors with null or non-finite components link with nothing.
An empty table gives no rows; rows that repeat a vec_id are one node of the graph.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackmetrics.llm.common import components, merge_labels, record_batch
from trackmetrics.session import materialise

THRESHOLD = 0.98
#: Vectors a cell should hold, cells of all labels together, rows of the fitting sample, rows of a block.
CELL_ROWS = 1_500
MAX_CELLS = 4_096
SAMPLE_ROWS = 65_536
BLOCK_ROWS = 1_024
ITERATIONS = 8


def fit(vectors: np.ndarray, cells: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Unit centroids of spherical k-means; starts are spread evenly over the rows as given."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cells = min(cells, len(unit))
    centres = unit[np.linspace(0, len(unit) - 1, cells).astype(int)].copy()
    for _ in range(iterations):
        own = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres


def _centroids(classes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Centroids per (label, length) that needs more than one cell; at most MAX_CELLS in all."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS)
    total = sizes.agg(F.sum("n")).first()[0]
    if not total:
        return {}
    share = min(1.0, SAMPLE_ROWS / total)
    room = min(MAX_CELLS, math.ceil(total / CELL_ROWS))
    # A label with less than one cell's share of all rows stays whole; there are at most MAX_CELLS others.
    wanted = sizes.withColumn("cells", F.floor(F.col("n") / F.lit(total) * F.lit(room)).cast("int")).where("cells > 1")
    picked = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = classes.where(picked).join(wanted.select("label", "dim", "cells"), ["label", "dim"]).select("label", "dim", "cells", "rep", "v")

    def run(key, table):
        rows = table.sort_by("rep")
        centres = fit(np.array(rows.column("v").to_pylist(), dtype=np.float64), rows.column("cells")[0].as_py())
        return pa.table({"label": [key[0].as_py()] * len(centres), "dim": [key[1].as_py()] * len(centres), "c": centres.tolist()},
                        schema=pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("c", pa.list_(pa.float64()))]))

    out: dict[tuple[int, int], list] = {}
    for r in sample.groupBy("label", "dim").applyInArrow(run, "label long, dim int, c array<double>").collect():
        out.setdefault((r["label"], r["dim"]), []).append(r["c"])
    return {k: np.array(v) for k, v in out.items()}


def _visits(classes: DataFrame, centroids: dict, threshold: float) -> DataFrame:
    """Each class in its own cell (visitor false) and in lower cells that may hold a partner (visitor true)."""
    schema = pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("visitor", pa.bool_()), ("rep", pa.int64()), ("copies", pa.int64()), ("v", pa.list_(pa.float64()))])
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    apart = {k: np.sqrt(np.maximum(0, 2 - 2 * c @ c.T)) for k, c in centroids.items()}

    def run(batches):
        for batch in batches:
            label, dim = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
            for key in {*zip(label.tolist(), dim.tolist())}:
                rows = np.flatnonzero((label == key[0]) & (dim == key[1]))
                part = batch.take(pa.array(rows))
                if key in centroids:
                    vectors = part.column("v").flatten().to_numpy().reshape(len(rows), key[1])
                    near = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ centroids[key].T
                    home = np.argmax(near, axis=1)
                    margin = near[np.arange(len(rows)), home][:, None] - near
                    goes = (margin <= reach * apart[key][home]) & (np.arange(near.shape[1])[None, :] < home[:, None])
                    guest, cell = np.nonzero(goes)
                else:
                    home, guest, cell = np.zeros(len(rows), int), np.zeros(0, int), np.zeros(0, int)
                order = np.concatenate([np.arange(len(rows)), guest])
                taken = part.take(pa.array(order))
                yield record_batch({
                    "label": taken.column("label"), "dim": taken.column("dim"), "cell": np.concatenate([home, cell]).astype(np.int32),
                    "visitor": np.concatenate([np.zeros(len(rows), bool), np.ones(len(guest), bool)]),
                    "rep": taken.column("rep"), "copies": taken.column("copies"), "v": taken.column("v"),
                }, schema)

    return classes.select("label", "dim", "rep", "copies", "v").mapInArrow(run, "label long, dim int, cell int, visitor boolean, rep long, copies long, v array<double>")


def _compare(units: DataFrame, threshold: float) -> DataFrame:
    """From rows of units: (a, n, null) with n other vectors linked to a, and (a, null, b) edges that connect all links."""
    schema = pa.schema([("a", pa.int64()), ("n", pa.int64()), ("b", pa.int64())])

    def run(key, table):
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        visitor, block = table.column("visitor").to_numpy(), table.column("block").to_numpy()
        v = np.array(table.column("v").combine_chunks().flatten().to_numpy()).reshape(len(rep), -1)
        length = np.linalg.norm(v, axis=1)
        across = key[3].as_py() != key[4].as_py()
        left = np.flatnonzero(block == key[3].as_py())
        right = np.flatnonzero(block == key[4].as_py()) if across else left
        link = (v[left] @ v[right].T) / np.outer(length[left], length[right]) >= threshold
        link &= ~(visitor[left, None] & visitor[None, right])
        if not across:
            np.fill_diagonal(link, False)
        n = np.zeros(len(rep), dtype=np.int64)
        n[left] = link @ copies[right]
        if across:
            n[right] += link.T @ copies[left]
        x, y = np.nonzero(link)
        labels = merge_labels(np.arange(len(rep)), left[x], right[y])
        some, own = np.flatnonzero(n), np.flatnonzero(labels != np.arange(len(rep)))
        return pa.table({
            "a": pa.array(np.concatenate([rep[some], rep[own]]), pa.int64()),
            "n": pa.array([*n[some].tolist(), *[None] * len(own)], pa.int64()),
            "b": pa.array([*[None] * len(some), *rep[labels[own]].tolist()], pa.int64()),
        }, schema=schema)

    return units.groupBy("label", "dim", "cell", "bi", "bj").applyInArrow(run, "a long, n long, b long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept (one representative per component)."""
    v = F.col(vector_col).cast("array<double>")
    base = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = base.where("label IS NOT NULL AND v IS NOT NULL").where(finite & F.exists("v", lambda x: x != 0))
    classes = usable.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes.where("rep IS NOT NULL").withColumn("dim", F.size("v")), "vectors")
    visits = materialise(_visits(classes, _centroids(classes), threshold), "cells")
    cells = ["label", "dim", "cell"]
    blocks = visits.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    dealt = visits.join(blocks, cells).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = dealt.select(*cells, F.least("block", "i").alias("bi"), F.greatest("block", "i").alias("bj"), "block", "visitor", "rep", "copies", "v")
    found = materialise(_compare(units, threshold), "cosine_links")
    links = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    comps = components(found.where("b IS NOT NULL").select("a", "b").distinct(), "embeddings")
    per_class = classes.join(links, F.col("rep") == F.col("a"), "left").join(comps, F.col("rep") == F.col("node"), "left").select(
        "label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    joined = base.join(per_class, ["label", "v"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
