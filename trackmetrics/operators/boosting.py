"""Leaf-wise gradient boosting on binned features: many models fitted side by side, scored on all rows.

A boosted tree needs the sums of the tree before it, so one model is sequential: a split as a Spark job each would be some ten
thousand jobs a model.  What Spark distributes are the models (settings, folds), the thresholds and the scoring.  A model is fitted
in one task on all labelled rows, which it holds as one byte a feature; every row is scored.

Rows whose label is null are not learned from.  A null feature counts as smaller than every number, in fitting and in scoring.
Without labelled rows a model does not exist and scores are null; with one class only it is its base score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackmetrics.operators import binned
from trackmetrics.session import materialise

#: Distinct values a feature is cut to.
BINS = 255
#: A side of a split must hold this much curvature, so that its value is finite.
MIN_CURVATURE = 1e-3
TREES = "model int, tree int, node int, feature int, threshold double, below int, above int, value double, cover double, gain double"


class Task(NamedTuple):
    """One model to fit: its setting (step, leaves, leaf_rows, rounds) and the rows it may learn from."""

    setting: tuple
    rows: Column


# -- fitting ---------------------------------------------------------------------------


def cut_points(values: np.ndarray) -> np.ndarray:
    """Ascending thresholds of one feature: midpoints of its distinct values, or of evenly spaced ones if they are too many."""
    known = np.unique(values[~np.isnan(values)])
    if len(known) > BINS:
        known = np.unique(np.quantile(values[~np.isnan(values)], np.linspace(0, 1, BINS), method="nearest"))
    return (known[:-1] + known[1:]) / 2


def best_split(hist: np.ndarray, leaf_rows: int) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best cut of a leaf, or None.

    ``hist`` holds slope, curvature and row count per (feature, bin); equal gains go to the first feature and bin.
    """
    g, h, n = hist.cumsum(axis=2)
    total_g, total_h, total_n = g[0, -1], h[0, -1], n[0, -1]
    allowed = (n >= leaf_rows) & (total_n - n >= leaf_rows) & (h >= MIN_CURVATURE) & (total_h - h >= MIN_CURVATURE)
    if not allowed.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(allowed, g**2 / h + (total_g - g) ** 2 / (total_h - h) - total_g**2 / total_h, -np.inf)
    at = int(gain.argmax())
    found = float(gain.flat[at])
    return (found, *divmod(at, hist.shape[2])) if found > 1e-10 else None


#: A leaf of fewer rows is summed for all features at once.
FEW_ROWS = 2000


class _Tree:
    """One tree, its best leaf cut first until the leaves are used up; ``codes`` has a line of bins per feature."""

    def __init__(self, codes: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: Sequence[np.ndarray], setting) -> None:
        self.codes, self.g, self.h, self.cuts = codes, g, h, cuts
        self.step, self.leaves, self.leaf_rows, _ = setting
        self.width = max(map(len, cuts)) + 1
        self.shift = np.arange(len(codes), dtype=np.intp)[:, None] * self.width
        self.nodes: list[list] = []
        self.rows: dict[int, np.ndarray] = {}
        self.open: list[tuple] = []
        self.add(np.arange(len(g)), None)
        while self.open and len(self.rows) < self.leaves:
            self.cut(*heapq.heappop(self.open))

    def histogram(self, rows: np.ndarray) -> np.ndarray:
        g, h = self.g[rows], self.h[rows]
        shape = len(self.codes), self.width
        if len(rows) < FEW_ROWS:
            place = (self.codes[:, rows] + self.shift).ravel()
            sums = [np.bincount(place, np.tile(w, shape[0]), shape[0] * self.width).reshape(shape) for w in (g, h)]
            return np.stack([*sums, np.bincount(place, minlength=shape[0] * self.width).reshape(shape)])
        out = np.empty((3, *shape))
        for j, line in enumerate(self.codes):
            place = (line if len(rows) == len(line) else line.take(rows)).astype(np.intp)
            out[0, j], out[1, j], out[2, j] = np.bincount(place, g, self.width), np.bincount(place, h, self.width), np.bincount(place, minlength=self.width)
        return out

    def add(self, rows: np.ndarray, hist: np.ndarray | None) -> int:
        node = len(self.nodes)
        hist = self.histogram(rows) if hist is None else hist
        curvature = self.h[rows].sum()
        value = -self.step * self.g[rows].sum() / curvature if curvature > 0 else 0.0
        self.nodes.append([-1, 0.0, -1, -1, float(value), float(len(rows)), 0.0])
        self.rows[node] = rows
        split = best_split(hist, self.leaf_rows) if len(rows) >= 2 * self.leaf_rows else None
        if split:
            heapq.heappush(self.open, (-split[0], node, split[1], split[2], hist))
        return node

    def cut(self, loss: float, node: int, feature: int, code: int, hist: np.ndarray) -> None:
        rows = self.rows.pop(node)
        low = self.codes[feature].take(rows) <= code
        sides = rows[low], rows[~low]
        # The histogram of the larger side is what the smaller one leaves of the parent's.
        small = int(len(sides[0]) > len(sides[1]))
        counted = self.histogram(sides[small])
        hists = (counted, hist - counted) if small == 0 else (hist - counted, counted)
        below, above = (self.add(r, x) for r, x in zip(sides, hists))
        self.nodes[node][:4] = [feature, float(self.cuts[feature][code]), below, above]
        self.nodes[node][6] = -loss


def grow(x: np.ndarray, y: np.ndarray, setting) -> tuple[float, list[list[list]]]:
    """(base score, trees) of logistic boosting with balanced classes; a tree is a list of nodes in the order of ``TREES``."""
    cuts = [cut_points(x[:, j]) for j in range(x.shape[1])]
    return grow_binned(binned.codes_of(cuts, x), y, cuts, setting)


def grow_binned(codes: np.ndarray, y: np.ndarray, cuts: Sequence[np.ndarray], setting) -> tuple[float, list[list[list]]]:
    """As :func:`grow`, for rows that are cut to bins: a line of codes per feature."""
    share = y.mean()
    if share in (0.0, 1.0):
        return (30.0 if share else -30.0), []
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    raw, trees = np.zeros(len(y)), []  # balanced classes: even odds before the first tree
    for _ in range(setting[3]):
        p = 1 / (1 + np.exp(-raw))
        tree = _Tree(codes, weight * (p - y), weight * p * (1 - p), cuts, setting)
        if len(tree.nodes) == 1:
            break  # nothing left to split; later rounds would find the same
        for node, rows in tree.rows.items():
            raw[rows] += tree.nodes[node][4]
        trees.append(tree.nodes)
    return 0.0, trees


def fit(df: DataFrame, features: Sequence[str], target: str, key: str, tasks: Mapping[int, Task], limit: int | None = None) -> DataFrame:
    """Stored trees of all ``tasks``, one task of the cluster each.  Row ``tree = -1`` of a model is its base score.

    A model learns from all its labelled rows.  Only a caller that gives a ``limit`` gets a sample of about as many, drawn by a hash of the key.
    """
    known = df.where(F.col(target).isNotNull())
    if limit is not None:
        share = F.lit(float(limit)) / F.greatest(F.lit(1), known.agg(F.count(F.lit(1))).scalar())
        known = known.where(F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
    width, models, settings = len(features), list(tasks), {m: tuple(t.setting) for m, t in tasks.items()}
    rows = binned.with_bits(known, features, target, {m: t.rows for m, t in tasks.items()}, F.col(key).cast("string").alias("__key"))
    cuts = binned.thresholds(rows.drop("__key"), width, models, lambda x, _: cut_points(x))
    # Sums do not depend on the order of arrival.
    ordered = rows.orderBy(F.col("__key").asc_nulls_last(), "__y", "__x").drop("__key")
    names = [c.split()[0] for c in TREES.split(", ")]

    def one_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple]] = {}
        for batch in batches:
            for model, *block in zip(*(batch.column(c).to_pylist() for c in ("model", "part", "seq", "codes", "y"))):
                found.setdefault(model, []).append(tuple(block))
        for model in sorted(found):
            codes, y = binned.joined(found.pop(model), width)
            base, trees = grow_binned(codes, y, cuts[model], settings[model])
            out = [(model, -1, 0, -1, 0.0, -1, -1, base, float(len(y)), 0.0)]
            out += [(model, t, i, *node) for t, nodes in enumerate(trees) for i, node in enumerate(nodes)]
            kinds = [pa.float64() if c.endswith("double") else pa.int32() for c in TREES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(zip(*out), kinds)], names)

    # A number each: every model has a task of its own, and those that take longest begin.
    longest = sorted(models, key=lambda m: -settings[m][1] * settings[m][3])
    place = F.create_map(*[F.lit(v) for i, m in enumerate(longest) for v in (m, i)])
    dealt = binned.blocks(ordered, width, models, cuts).repartitionById(len(tasks), F.element_at(place, F.col("model")))
    return materialise(dealt.mapInArrow(one_model, TREES), "trees")


# -- scoring ---------------------------------------------------------------------------


class Model(NamedTuple):
    """Trees of one model as flat arrays; a leaf has feature -1, and the trees' roots are at ``roots``."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    cover: np.ndarray


def load(trees: DataFrame) -> dict[int, Model]:
    """Models by number.  Rounds times twice the leaves bounds the rows of a model: a few MB, whatever the data."""
    out = {}
    for number, rows in trees.toPandas().sort_values(["model", "tree", "node"]).groupby("model"):
        nodes = rows[rows["tree"] >= 0]
        roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
        start = roots[nodes["tree"].to_numpy()] if len(roots) else np.zeros(0, dtype=int)
        at = lambda c: np.where(nodes[c].to_numpy() >= 0, nodes[c].to_numpy() + start, -1)
        out[int(number)] = Model(
            float(rows.loc[rows["tree"] < 0, "value"].iloc[0]), roots, nodes["feature"].to_numpy(), nodes["threshold"].to_numpy(),
            at("below"), at("above"), nodes["value"].to_numpy(), nodes["cover"].to_numpy())
    return out


def raw_scores(model: Model, x: np.ndarray) -> np.ndarray:
    """Log odds of each row; a node of a tree parts the rows that reach it, so a row costs its own depth and no block of rows times trees is held."""
    out = np.full(len(x), model.base)
    columns = np.ascontiguousarray(x.T)
    feature, threshold, below, above, value = (a.tolist() for a in (model.feature, model.threshold, model.below, model.above, model.value))
    every = np.arange(len(x))
    for root in model.roots.tolist():
        todo = [(root, every)]
        while todo:
            node, rows = todo.pop()
            if feature[node] < 0:
                out[rows] += value[node]
            elif len(rows):
                high = columns[feature[node]].take(rows) > threshold[node]  # a null is on the lower side
                todo += [(above[node], rows.compress(high)), (below[node], rows.compress(~high))]
    return out


def features_of(columns: Sequence[pd.Series]) -> np.ndarray:
    return np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns], axis=1)


def score(df: DataFrame, features: Sequence[str], model: Model | None, name: str = "score") -> DataFrame:
    """All rows with the probability of the label."""
    if model is None:
        return df.withColumn(name, F.lit(None).cast("double"))

    @F.pandas_udf("double")
    def probability(*columns: pd.Series) -> pd.Series:
        return pd.Series(1 / (1 + np.exp(-raw_scores(model, features_of(columns)))))

    return df.withColumn(name, probability(*[F.col(c).cast("double") for c in features]))


# -- contributions ----------------------------------------------------------------------


class Path(NamedTuple):
    """A leaf: its value and, per feature on its way, the interval ]low, high] and the share of training rows that stay."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def paths(model: Model) -> list[Path]:
    out = []
    todo = [(int(root), {}) for root in model.roots]
    while todo:
        node, seen = todo.pop()
        feature = int(model.feature[node])
        if feature < 0:
            names = sorted(seen)
            out.append(Path(float(model.value[node]), np.array(names, dtype=int), *(np.array([seen[f][i] for f in names]) for i in range(3))))
            continue
        low, high, share = seen.get(feature, (-np.inf, np.inf, 1.0))
        for child, limits in ((model.below[node], (low, min(high, model.threshold[node]))), (model.above[node], (max(low, model.threshold[node]), high))):
            todo.append((int(child), {**seen, feature: (*limits, share * model.cover[child] / model.cover[node])}))
    return out


def expected(model: Model, leaves: Sequence[Path]) -> float:
    """Score of a row of which nothing is known: leaves weighted by their share of the training rows."""
    return model.base + sum(p.value * float(np.prod(p.share)) for p in leaves)


def _gains(leaf: Path, stays: np.ndarray) -> np.ndarray:
    """Contribution of each feature of a leaf, for rows that stay on its way by the features that are 1.

    A known feature counts 1 or 0 (the row stays or not), an unknown one its share.  The weight of a set of known features,
    k! (d-1-k)! / d!, is the integral of t^k (1-t)^(d-1-k) over [0, 1].  The sum over all sets is thus the integral of a product of
    d - 1 linear factors, which Gauss-Legendre nodes integrate exactly: d steps instead of 2^d sets.
    """
    nodes, weights = np.polynomial.legendre.leggauss((len(leaf.features) + 1) // 2)
    gain = np.zeros(stays.shape)
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = stays * t + leaf.share * (1 - t)  # positive: no share is 0
        gain += w * factor.prod(axis=1, keepdims=True) / factor
    return leaf.value * (stays - leaf.share) * gain


#: A leaf of at most so many features has a table of its contributions: a column per set of features that a row stays by.
TABLE_FEATURES = 9


class Lookup(NamedTuple):
    """What contributions need of a model, whatever the rows: thresholds per feature, and per leaf its (feature, place of low, place of high), path and table."""

    bounds: list[np.ndarray]
    leaves: list[tuple[list[tuple[int, int, int]], Path, np.ndarray | None]]


def lookup(leaves: Sequence[Path], n_features: int) -> Lookup:
    found: list[set[float]] = [set() for _ in range(n_features)]
    for leaf in leaves:
        for f, low, high in zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist()):
            found[f].update((low, high))
    bounds = [np.array(sorted(s)) for s in found]
    place = [{v: i for i, v in enumerate(b.tolist())} for b in bounds]
    out = []
    for leaf in leaves:
        d = len(leaf.features)
        if not d:
            continue
        # -inf as the lower end holds every row, a null too
        limits = [(f, -1 if low == -np.inf else place[f][low], place[f][high]) for f, low, high in zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist())]
        table = np.ascontiguousarray(_gains(leaf, (np.arange(1 << d)[:, None] >> np.arange(d)) & 1).T) if d <= TABLE_FEATURES else None
        out.append((limits, leaf, table))
    return Lookup(bounds, out)


def contributions(known: Lookup | Sequence[Path], x: np.ndarray) -> np.ndarray:
    """Exact Shapley value of each feature for each row, unknown features following the training shares of the tree.

    A row enters a leaf only by the features it stays with: rows look their contributions up in the leaf's table, unless the leaf has many features.
    """
    if not isinstance(known, Lookup):
        known = lookup(known, x.shape[1])
    out = np.zeros(x.shape[::-1])
    # A null is below every threshold.  Places among the thresholds decide as the numbers do, and are small.
    codes = [np.searchsorted(b, np.where(np.isnan(c), -np.inf, c)).astype(np.int32) for b, c in zip(known.bounds, x.T)]
    for limits, leaf, table in known.leaves:
        own = [codes[f] <= high if low < 0 else (codes[f] > low) & (codes[f] <= high) for f, low, high in limits]
        if table is None:
            out[leaf.features] += _gains(leaf, np.stack(own, axis=1)).T
            continue
        at = own[0].astype(np.uint16)
        for i, stays in enumerate(own[1:], 1):
            at |= np.left_shift(stays, i, dtype=np.uint16)
        at = at.astype(np.intp)
        for (f, _, _), gain in zip(limits, table):
            out[f] += gain.take(at)
    return out.T


def explain(df: DataFrame, features: Sequence[str], model: Model) -> DataFrame:
    """All rows with ``raw`` (log odds), ``base`` (expected log odds) and ``shap``, an array with one value per feature."""
    leaves = paths(model)
    base = expected(model, leaves)
    known = df.sparkSession.sparkContext.broadcast(lookup(leaves, len(features)))  # the model's own size, whatever the rows

    @F.pandas_udf("raw double, base double, shap array<double>")
    def shapley(*columns: pd.Series) -> pd.DataFrame:
        x = features_of(columns)
        return pd.DataFrame({"raw": raw_scores(model, x), "base": base, "shap": list(contributions(known.value, x))})

    return df.withColumn("__e", shapley(*[F.col(c).cast("double") for c in features])).select(*df.columns, "__e.*")
