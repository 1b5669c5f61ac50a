"""Random forest of deep trees: a task learns some trees, each from a bootstrap of all rows, and scores with them at once.

The trees of a forest do not depend on one another, so a task takes ``TREES_OF_A_TASK`` of them with all rows as one byte a feature
and grows a tree level by level in arrays; there is no job per level, and no forest is gathered.  The rules are those of MLlib's
forest: a Poisson bootstrap, balanced class weights, Gini gain, the root of the number of features drawn per node, at most 32 bins cut by weight, leaves
of at least so many rows, sibling leaves of one verdict merged, probabilities averaged over trees.  Bins count all rows, where MLlib
takes 10,000 of a larger table.  Draws follow the seed and the number of the tree, not the layout of the rows.

A null feature counts as smaller than every number; rows without a label are scored, not learned from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackmetrics.operators import binned
from trackmetrics.session import materialise

MAX_BINS = 32
TREES_OF_A_TASK = 25
#: Nodes whose cuts are compared at once: their arrays stay in a core's cache.
NODES_AT_ONCE = 2048
#: A tree per row; the arrays have a place per node, children stand side by side from ``below``, a leaf has feature -1.
TREES = "tree int, feature array<int>, cut array<int>, below array<int>, value array<double>, importance array<double>"
EPSILON = 2.0**-52


def weighted_cuts(values: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Thresholds between all distinct values, or between strides of equal class-balanced weight if they are too many."""
    held = ~np.isnan(values)
    known, at = np.unique(values[held], return_inverse=True)
    mids = (known[:-1] + known[1:]) / 2
    if len(mids) < MAX_BINS:
        return mids
    hit, low, high = labels[held] == 1, *class_weights(labels)
    upto = (np.bincount(at, ~hit) * low + np.bincount(at, hit) * high).cumsum()
    between, stride, out, start = (upto[:-1] + upto[1:]) / 2, upto[-1] / MAX_BINS, [], 0
    while start < len(between) and len(out) < MAX_BINS - 1:
        # The cut before the first value that would move the count away from its aim.
        i = max(start, int(np.searchsorted(between, stride * (len(out) + 1), side="right")))
        if i >= len(between):
            break
        out.append(mids[i])
        start = i + 1
    return np.array(out)


def class_weights(labels: np.ndarray) -> tuple[float, float]:
    """Weights of a row without and with the label: both classes count as much."""
    share = labels.mean() if len(labels) else 0.0
    return (0.5 / (1 - share) if share < 1 else 0.0), (0.5 / share if share > 0 else 0.0)


class Tree(NamedTuple):
    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    value: np.ndarray
    importance: np.ndarray


def grow(codes: np.ndarray, width: int, weights: tuple[float, float], depth: int, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """A tree on a Poisson bootstrap.  ``codes``: flat, rows by features, each twice the bin plus the label."""
    n_rows = len(codes) // width
    times = rng.poisson(1.0, n_rows).astype(np.uint8)
    rows = np.flatnonzero(times)
    first, times = rows * width, times[rows].astype(float)
    bins, drawn = 2 * MAX_BINS, math.ceil(math.sqrt(width))
    hits = times[(codes[first] & 1).astype(bool)].sum()
    count = np.array([[times.sum() - hits, hits]])
    low, high = weights
    slot = np.zeros(len(rows), np.intp)
    counts, features, cuts, belows, gains = [count], [np.array([-1], np.int32)], [np.zeros(1, np.int32)], [np.full(1, -1, np.int32)], [np.zeros(1)]
    open_nodes, total = np.flatnonzero(count.min(axis=1) > 0), 1
    for level in range(depth):
        # Nodes of the level that may be cut, with their rows: ``slot`` numbers them.
        n_open = len(open_nodes)
        if not n_open:
            break
        all_n, all_hit = count[open_nodes].sum(axis=1), count[open_nodes, 1]
        whole = 2 * _gini(low * (all_n - all_hit), high * all_hit)
        best, best_at, best_feature = np.full(n_open, -np.inf), np.zeros(n_open, np.intp), np.zeros(n_open, np.intp)
        best_n, best_hit = np.zeros(n_open), np.zeros(n_open)
        asked = np.argsort(rng.random((n_open, width)), axis=1)[:, :drawn]
        base = slot * bins
        for j in range(drawn):
            asked_j = np.ascontiguousarray(asked[:, j])
            place = codes.take(first + asked_j.take(slot))
            hist = np.bincount(base + place, times, n_open * bins).reshape(n_open, MAX_BINS, 2)
            for i in range(0, n_open, NODES_AT_ONCE):
                some = slice(i, i + NODES_AT_ONCE)
                at, gain, n_left, hit_left = _best_cut(hist[some], all_n[some], all_hit[some], low, high, leaf_rows)
                better = np.flatnonzero(gain > best[some])
                to = better + i
                best[to], best_at[to], best_feature[to] = gain[better], at[better], asked_j[to]
                best_n[to], best_hit[to] = n_left[better], hit_left[better]
        best = whole + 2 * best
        split = (best_n > 0) & (best > 1e-12 * np.maximum(whole, EPSILON))
        cut_nodes = open_nodes[split]
        features[-1][cut_nodes], cuts[-1][cut_nodes] = best_feature[split], best_at[split]
        n_cut = len(cut_nodes)
        if not n_cut:
            break
        belows[-1][cut_nodes] = total + 2 * np.arange(n_cut)
        gains[-1][cut_nodes] = best[split]
        left = np.stack([best_n[split] - best_hit[split], best_hit[split]], axis=1)
        children = np.empty((2 * n_cut, 2))
        children[0::2], children[1::2] = left, count[cut_nodes] - left
        # Rows go to their child; those of finished children are done.
        alive = (children.sum(axis=1) >= 2 * leaf_rows) & (children.min(axis=1) > 0) & (level + 1 < depth)
        new_slot = np.where(alive, alive.cumsum() - 1, -1)
        number = np.where(split, split.cumsum() - 1, -1)
        goes = codes.take(first + best_feature.take(slot)) > (2 * best_at + 1).take(slot)
        child = 2 * number.take(slot) + goes
        slot = np.where(number.take(slot) >= 0, new_slot.take(np.maximum(child, 0)), -1)
        keep = slot >= 0
        first, times, slot = first[keep], times[keep], slot[keep]
        total, count = total + 2 * n_cut, children
        open_nodes = np.flatnonzero(alive)
        counts.append(children)
        features.append(np.full(2 * n_cut, -1, np.int32))
        cuts.append(np.zeros(2 * n_cut, np.int32))
        belows.append(np.full(2 * n_cut, -1, np.int32))
        gains.append(np.zeros(2 * n_cut))
    return _pruned(counts, features, cuts, belows, gains, weights, width)


def _gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Half the Gini impurity times the weight of a node."""
    weight = a + b
    return np.divide(a * b, weight, out=np.zeros_like(weight), where=weight > 0)


def _best_cut(hist: np.ndarray, all_n: np.ndarray, all_hit: np.ndarray, low: float, high: float, leaf_rows: int) -> tuple[np.ndarray, ...]:
    """Per node: bin, minus what remains of half the impurity, rows and hits below, of the best cut; -inf remains where none is allowed."""
    miss, hit = (hist[:, :-1, i].cumsum(axis=1) for i in (0, 1))
    n = miss + hit
    a, b = low * miss, high * hit
    c, d = (low * (all_n - all_hit))[:, None] - a, (high * all_hit)[:, None] - b
    with np.errstate(divide="ignore", invalid="ignore"):
        remains = a * b / (a + b) + c * d / (c + d)
    remains[(n < leaf_rows) | (n > (all_n - leaf_rows)[:, None])] = np.inf
    at = remains.argmin(axis=1)
    every = np.arange(len(at))
    return at, -remains[every, at], n[every, at], hit[every, at]


def _pruned(counts, features, cuts, belows, gains, weights: tuple[float, float], width: int) -> Tree:
    """One array a field; sibling leaves of one verdict become their parent, from the deepest level up."""
    ends = np.cumsum([len(c) for c in counts])
    count, feature, cut, below, gain = (np.concatenate(a) for a in (counts, features, cuts, belows, gains))
    a, b = weights[0] * count[:, 0], weights[1] * count[:, 1]
    verdict = b > a
    for stop, size in zip(ends[::-1], [len(c) for c in counts][::-1]):
        inner = stop - size + np.flatnonzero(feature[stop - size : stop] >= 0)
        left = below[inner]
        same = inner[(feature[left] < 0) & (feature[left + 1] < 0) & (verdict[left] == verdict[left + 1])]
        feature[same], below[same], gain[same] = -1, -1, 0.0
    weight = a + b
    inner = feature >= 0
    importance = np.bincount(feature[inner], gain[inner], width) if inner.any() else np.zeros(width)
    # Nodes below a merged one are left out; parents come before children, and siblings stay together.
    reached = np.zeros(len(feature), bool)
    reached[0] = True
    for stop, size in zip(ends, [len(c) for c in counts]):
        inner = stop - size + np.flatnonzero(reached[stop - size : stop] & (feature[stop - size : stop] >= 0))
        reached[below[inner]] = reached[below[inner] + 1] = True
    number = reached.cumsum() - 1
    value = np.divide(b, weight, out=np.zeros_like(b), where=weight > 0)
    new_below = np.where(feature >= 0, number[below], -1)
    return Tree(feature[reached], cut[reached], new_below[reached].astype(np.int32), value[reached], importance / importance.sum() if importance.sum() > 0 else importance)


def descend(tree: Tree, codes: np.ndarray, width: int) -> np.ndarray:
    """Probability of each row; ``codes`` is flat, rows by features, bins alone."""
    return _down(tree, codes, width, np.arange(len(codes) // width))


def _down(tree: Tree, codes: np.ndarray, width: int, rows: np.ndarray, node: np.ndarray | None = None, other: np.ndarray | None = None, swapped: np.ndarray | None = None) -> np.ndarray:
    """Values of the leaves that ``rows`` reach from ``node``; a row reads its feature ``swapped`` from ``other``."""
    node = np.zeros(len(rows), np.intp) if node is None else node
    out, place = tree.value.take(node), np.flatnonzero(tree.feature.take(node) >= 0)
    rows, node = rows.take(place), node.take(place)
    swapped = None if swapped is None else swapped.take(place)
    while len(rows):
        feature = tree.feature.take(node)
        at = rows * width + feature
        found = codes.take(at)
        if swapped is not None:
            theirs = np.flatnonzero(feature == swapped)
            found[theirs] = other.take(at.take(theirs))
        node = tree.below.take(node) + (found > tree.cut.take(node))
        inner = tree.feature.take(node) >= 0
        done = np.flatnonzero(~inner)
        out[place.take(done)] = tree.value.take(node.take(done))
        rows, node, place = rows[inner], node[inner], place[inner]
        swapped = None if swapped is None else swapped[inner]
    return out


def descend_swapped(tree: Tree, codes: np.ndarray, other: np.ndarray, width: int) -> np.ndarray:
    """Probability of each row as it is, and with each feature in turn from ``other``: a line each.

    A swapped row leaves the way of its own row at the first node that parts the two; only from there it has a way of its own.
    """
    n = len(codes) // width
    rows, node, left = np.arange(n), np.zeros(n, np.intp), np.zeros(n * width, bool)
    branches = []
    while len(rows):
        inner = tree.feature.take(node) >= 0
        rows, node = rows[inner], node[inner]
        feature, cut = tree.feature.take(node), tree.cut.take(node)
        at = rows * width + feature
        own, theirs = codes.take(at) > cut, other.take(at) > cut
        apart = np.flatnonzero((own != theirs) & ~left.take(at))
        left[at.take(apart)] = True
        below = tree.below.take(node)
        branches.append((rows.take(apart), feature.take(apart), (below + theirs).take(apart)))
        node = below + own
    out = np.repeat(descend(tree, codes, width)[None], width + 1, axis=0)
    at, swapped, start = (np.concatenate([b[i] for b in branches]).astype(np.intp) for i in range(3))
    out[swapped + 1, at] = _down(tree, codes, width, at, start, other, swapped)
    return out


# -- over tables ------------------------------------------------------------------------

_LEARN, _SCORE = 0, 1
_SUMS = "part int, seq int, group int, y binary, sums binary"
_TASK = "group int, model int, part int, seq int, codes binary, y binary, tree int, feature array<int>, cut array<int>, below array<int>, value array<double>"


def _gathered(batches: Iterator[pa.RecordBatch], by: str) -> dict[int, list[dict]]:
    found: dict[int, list[dict]] = {}
    for batch in batches:
        for row in zip(*(batch.column(c) for c in batch.schema.names)):
            row = dict(zip(batch.schema.names, row))
            found.setdefault(row[by].as_py(), []).append(row)
    return found


def _bins(row: dict) -> np.ndarray:
    return np.frombuffer(row["codes"].as_buffer(), np.uint8)


def _in_groups(rows: DataFrame, groups: int) -> DataFrame:
    """A copy of the rows for each group of trees."""
    return rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))


def _learning(found: Sequence[dict], width: int) -> tuple[np.ndarray, tuple[float, float]]:
    """Flat codes with labels for :func:`grow`, in an order that rows decide by their content, and the class weights."""
    codes, y = binned.joined([(r["part"].as_py(), r["seq"].as_py(), r["codes"].as_py(), r["y"].as_py()) for r in found], width)
    lines = np.ascontiguousarray((codes << 1 | (y == 1)).astype(np.uint8).T)
    return np.sort(lines.view(f"S{width}").ravel()).view(np.uint8), class_weights(y)


def _sums(trees: Sequence[Tree], block: dict, group: int, width: int, swapped: bool = False) -> pa.RecordBatch:
    """Probabilities of a block summed over the trees; with ``swapped``, also with each feature in turn from the second half of the features."""
    lines = _bins(block).reshape(-1, len(block["y"].as_buffer()) // 8)
    own, other = np.ascontiguousarray(lines[:width].T).ravel(), np.ascontiguousarray(lines[width:].T).ravel()
    total = np.zeros((width + 1 if swapped else 1, lines.shape[1]))
    for tree in trees:
        total += descend_swapped(tree, own, other, width) if swapped else descend(tree, own, width)
    return pa.RecordBatch.from_pydict({
        "part": pa.array([block["part"].as_py()], pa.int32()), "seq": pa.array([block["seq"].as_py()], pa.int32()),
        "group": pa.array([group], pa.int32()), "y": [block["y"].as_py()], "sums": [total.tobytes()]})


def _averaged(sums: DataFrame, n_trees: int, n_swaps: int, target: str) -> DataFrame:
    """``target`` and the array ``scores`` of each row, from the sums of all groups of trees."""

    def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[tuple, list[tuple]] = {}
        for batch in batches:
            for part, seq, group, y, found in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "group", "y", "sums"))):
                whole.setdefault((part, seq), []).append((group, y, found))
        for parts in whole.values():
            parts.sort(key=lambda p: p[0])  # sums do not depend on the order of arrival
            y = np.frombuffer(parts[0][1], float)
            total = sum(np.frombuffer(p[2], float) for p in parts).reshape(n_swaps, -1) / n_trees
            scores = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * n_swaps, np.ascontiguousarray(total.T).ravel())
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.float64(), mask=np.isnan(y)), scores], [target, "scores"])

    return sums.repartition("part", "seq").mapInArrow(averaged, f"`{target}` double, scores array<double>")


class Forest(Estimator):
    """``trees`` trees to ``depth`` with at least ``leaf_rows`` rows in a leaf."""

    def __init__(self, features: Sequence[str], target: str, trees: int, depth: int, leaf_rows: int, seed: int) -> None:
        super().__init__()
        self.features, self.target, self.trees, self.depth, self.leaf_rows, self.seed = list(features), target, trees, depth, leaf_rows, seed

    def getNumTrees(self) -> int:
        return self.trees

    def getMaxDepth(self) -> int:
        return self.depth

    def getMinInstancesPerNode(self) -> int:
        return self.leaf_rows

    @property
    def groups(self) -> int:
        return -(-self.trees // TREES_OF_A_TASK)

    def _rows(self, df: DataFrame, role: int) -> DataFrame:
        return binned.with_bits(df, self.features, self.target, {role: F.lit(True)})

    def _learned(self, train: DataFrame) -> tuple[DataFrame, list[np.ndarray] | None]:
        """Blocks of the labelled rows and the thresholds of each feature, which are None without such rows."""
        rows = self._rows(train.where(F.col(self.target).isNotNull()), _LEARN)
        cuts = binned.thresholds(rows, len(self.features), [_LEARN], weighted_cuts).get(_LEARN)
        return (binned.blocks(rows, len(self.features), [_LEARN], {_LEARN: cuts}) if cuts else None), cuts

    def _grower(self):
        width, count, depth, leaf_rows, seed = len(self.features), self.trees, self.depth, self.leaf_rows, self.seed

        def grown(group: int, found: Sequence[dict]) -> Iterator[tuple[int, Tree]]:
            codes, weights = _learning(found, width)
            for number in range(group * TREES_OF_A_TASK, min(count, (group + 1) * TREES_OF_A_TASK)):
                yield number, grow(codes, width, weights, depth, leaf_rows, np.random.default_rng([seed, number]))

        return grown

    def held_out(self, train: DataFrame, test: DataFrame) -> DataFrame:
        """``target`` and ``score`` of the rows of ``test``; trees score as they are learned and are not kept."""
        learn, cuts = self._learned(train)
        if cuts is None:
            return test.select(self.target, F.lit(None).cast("double").alias("score"))
        width, grown = len(self.features), self._grower()
        score = binned.blocks(self._rows(test, _SCORE), width, [_SCORE], {_SCORE: cuts})

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group, found in _gathered(batches, "group").items():
                trees = [tree for _, tree in grown(group, [r for r in found if r["model"].as_py() == _LEARN])]
                for r in found:
                    if r["model"].as_py() == _SCORE:
                        yield _sums(trees, r, group, width)

        dealt = _in_groups(learn.unionByName(score), self.groups).repartitionById(self.groups, F.col("group"))
        return _one_score(_averaged(dealt.mapInArrow(learned, _SUMS), self.trees, 1, self.target), test, self.target)

    def _fit(self, train: DataFrame) -> ForestModel:
        learn, cuts = self._learned(train)
        if cuts is None:
            raise ValueError(f"no row has a label {self.target}")
        grown = self._grower()
        names = [c.split()[0] for c in TREES.split(", ")]

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group, found in _gathered(batches, "group").items():
                for number, tree in grown(group, found):
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *[
                        pa.array([v], pa.list_(kind)) for v, kind in zip(tree, (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()))]], names)

        dealt = _in_groups(learn, self.groups).repartitionById(self.groups, F.col("group"))
        return ForestModel(self.features, self.target, self.trees, materialise(dealt.mapInArrow(learned, TREES), "forest"), cuts)


def _one_score(scored: DataFrame, like: DataFrame, target: str) -> DataFrame:
    return scored.select(F.col(target).cast(like.schema[target].dataType).alias(target), F.col("scores")[0].alias("score"))


class ForestModel(Model):
    """A table of trees and the thresholds of its features.  Scoring deals trees and copies of the rows to tasks and averages their sums."""

    def __init__(self, features: Sequence[str], target: str, trees: int, table: DataFrame, cuts: Sequence[np.ndarray]) -> None:
        super().__init__()
        self.features, self.target, self.trees, self.table, self.cuts = list(features), target, trees, table, list(cuts)

    @property
    def featureImportances(self) -> DenseVector:
        """Gain of the Gini impurity by feature: shares of each tree, averaged; one number per feature reaches the driver."""
        sums = self.table.agg(*[F.sum(F.col("importance")[j]) for j in range(len(self.features))]).first()
        total = sum(sums)
        return DenseVector([s / total if total else 0.0 for s in sums])

    def _scores(self, df: DataFrame, features: Sequence[str], swapped: bool = False) -> DataFrame:
        width, groups = len(self.features), -(-self.trees // TREES_OF_A_TASK)
        cuts = self.cuts * (len(features) // width)
        rows = binned.with_bits(df, features, self.target, {_SCORE: F.lit(True)})
        score = _in_groups(binned.blocks(rows, len(features), [_SCORE], {_SCORE: cuts}), groups)
        trees = self.table.withColumn("group", F.floor(F.col("tree") / TREES_OF_A_TASK).cast("int"))
        names = [c.split()[0] for c in _TASK.split(", ")]
        dealt = score.unionByName(trees, allowMissingColumns=True).select(*names).repartitionById(groups, F.col("group"))

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group, found in _gathered(batches, "group").items():
                kept = sorted((r for r in found if r["tree"].is_valid), key=lambda r: r["tree"].as_py())
                own = [Tree(*(r[c].values.to_numpy() for c in ("feature", "cut", "below", "value")), np.zeros(0)) for r in kept]
                for r in found:
                    if r["codes"].is_valid:
                        yield _sums(own, r, group, width, swapped)

        return _averaged(dealt.mapInArrow(summed, _SUMS), self.trees, width + 1 if swapped else 1, self.target)

    def _transform(self, df: DataFrame) -> DataFrame:
        """``target`` and ``score`` of each row."""
        return _one_score(self._scores(df, self.features), df, self.target)

    def permuted(self, paired: DataFrame) -> DataFrame:
        """``target`` and ``scores`` of each row: first as it is, then with one feature at a time from the struct ``donor``."""
        donors = [f"__donor_{j}" for j in range(len(self.features))]
        rows = paired.select(self.target, *self.features, *[F.col(f"donor.{f}").alias(d) for f, d in zip(self.features, donors)])
        return self._scores(rows, [*self.features, *donors], swapped=True)

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/trees")
        cuts = [(j, f, self.target, c.tolist()) for j, (f, c) in enumerate(zip(self.features, self.cuts))]
        self.table.sparkSession.createDataFrame(cuts, "place int, feature string, target string, cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")


def load(spark: SparkSession, path: str) -> ForestModel:
    """A model that :meth:`ForestModel.save` wrote."""
    table = spark.read.parquet(f"{path}/trees")
    cuts = spark.read.parquet(f"{path}/cuts").orderBy("place").collect()  # a row per feature
    return ForestModel([r["feature"] for r in cuts], cuts[0]["target"], table.count(), table, [np.array(r["cuts"], dtype=float) for r in cuts])
