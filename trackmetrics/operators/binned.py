"""Rows as bytes of bins: whole tables reach the tasks that learn trees.

Thresholds of a feature come from all rows a model may learn from; one task takes a feature.  Rows are then cut to one byte a
feature and sent in blocks, so a task that needs every row of a model holds some twenty bytes a row, whatever its values take.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

#: Models are bits of a long.
MOST_MODELS = 62
BLOCK = "model int, part int, seq int, n int, codes binary, y binary"


def member_bits(models: Mapping[int, Column]) -> Column:
    """The models that may learn from a row, as bits in the order of ``models``; a null condition does not hold."""
    if len(models) > MOST_MODELS:
        raise ValueError(f"at most {MOST_MODELS} models are fitted together")
    bits = F.lit(0).cast("long")
    for i, rows in enumerate(models.values()):
        bits = bits + F.when(rows, F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return bits


def with_bits(df: DataFrame, features: Sequence[str], target: str, models: Mapping[int, Column], *extra: Column) -> DataFrame:
    """``__bits``, ``__y`` and ``__x`` of each row, the form :func:`thresholds` and :func:`blocks` read."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    return df.select(member_bits(models).alias("__bits"), F.col(target).cast("double").alias("__y"), x.alias("__x"), *extra)


def numbers(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (rows x width, null as NaN), label and bits of a batch."""
    x = batch.column("__x").flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, width)
    return x, batch.column("__y").to_numpy(zero_copy_only=False).astype(float, copy=False), batch.column("__bits").to_numpy()


def codes_of(cuts: Sequence[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Bin of each value, one line per feature; a null is in the lowest one."""
    out = np.empty(x.shape[::-1], np.uint8)
    for j, c in enumerate(cuts):
        out[j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(c, x[:, j]))
    return out


def thresholds(rows: DataFrame, width: int, models: Sequence[int], rule: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> dict[int, list[np.ndarray]]:
    """Thresholds per model and feature by ``rule(values, labels)`` over all rows of the model; at most 255 numbers each reach the driver."""

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, bits = numbers(batch, width)
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(range(width), pa.int32()), "x": [x[:, j].tobytes() for j in range(width)],
                "y": [y.tobytes()] * width, "bits": [bits.tobytes()] * width})

    def of_feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            for f, *blobs in zip(*(batch.column(c).to_pylist() for c in ("feature", "x", "y", "bits"))):
                parts.setdefault(f, []).append(blobs)
        for f, found in parts.items():
            x, y, bits = (np.frombuffer(b"".join(p[i] for p in found), kind) for i, kind in enumerate((float, float, np.int64)))
            own = [(m, (bits >> i & 1).astype(bool)) for i, m in enumerate(models)]
            own = [(m, keep) for m, keep in own if keep.any()]
            yield pa.RecordBatch.from_pydict({
                "model": pa.array([m for m, _ in own], pa.int32()), "feature": pa.array([f] * len(own), pa.int32()),
                "cuts": pa.array([rule(x[keep], y[keep]).tolist() for _, keep in own], pa.list_(pa.float64()))})

    lines = rows.mapInArrow(turned, "feature int, x binary, y binary, bits binary").repartitionById(width, F.col("feature"))
    out: dict[int, list] = {}
    for r in lines.mapInArrow(of_feature, "model int, feature int, cuts array<double>").collect():
        out.setdefault(r["model"], [None] * width)[r["feature"]] = np.array(r["cuts"], dtype=float)
    return out


def blocks(rows: DataFrame, width: int, models: Sequence[int], cuts: Mapping[int, Sequence[np.ndarray]]) -> DataFrame:
    """Codes (line per feature) and labels of the rows of each model; blocks in the order of (part, seq) keep the order of the rows."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, batch in enumerate(batches):
            x, y, bits = numbers(batch, width)
            for i, m in enumerate(models):
                keep = (bits >> i & 1).astype(bool)
                if keep.any():
                    yield pa.RecordBatch.from_pydict({
                        "model": pa.array([m], pa.int32()), "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                        "n": pa.array([int(keep.sum())], pa.int32()), "codes": [codes_of(cuts[m], x[keep]).tobytes()], "y": [y[keep].tobytes()]})

    return rows.mapInArrow(packed, BLOCK)


def joined(found: Sequence[tuple], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, labels) of blocks given as (part, seq, codes, y)."""
    found = sorted(found, key=lambda b: b[:2])
    codes = np.concatenate([np.frombuffer(b[2], np.uint8).reshape(width, -1) for b in found], axis=1)
    return codes, np.frombuffer(b"".join(b[3] for b in found), float)
