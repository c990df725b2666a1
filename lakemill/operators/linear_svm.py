"""A linear support vector machine with squared hinge loss and L2 penalty, by L-BFGS over the cluster.

Minimised is (|w|^2 + b^2) / 2 + C * sum of weight * max(0, 1 - y (w x + b))^2, y being -1 or 1; the intercept is penalised as
a weight of its own. Each partition's rows are sparse matrices that stay where they are; a step broadcasts the weights
and adds up the loss and its gradient in ``treeAggregate``, so that the driver gets a few vectors of the features' size.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one sparse matrix.
BLOCK = 4096


#: Partitions whose sums go to the driver at once; of more, sums of sums do.
AT_ONCE = 16


def _block(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Rows in compressed form: entries a row, features, values, y and weight."""
    vectors, label, weight = batch.columns
    values = vectors.field("values")
    if pc.sum(vectors.field("type")).as_py() == 0:
        indices, counts = vectors.field("indices").flatten().to_numpy(), values.value_lengths().to_numpy(zero_copy_only=False)
        values = values.flatten().to_numpy()
    else:  # dense ones have no indices
        rows = [(v["indices"], np.array(v["values"], float)) for v in vectors.to_pylist()]
        pairs = [(np.array(i), v) if i is not None else (np.flatnonzero(v), v[np.flatnonzero(v)]) for i, v in rows]
        counts, indices, values = [len(i) for i, _ in pairs], np.concatenate([i for i, _ in pairs]), np.concatenate([v for _, v in pairs])
    y = np.where(label.to_numpy(zero_copy_only=False) > 0, 1.0, -1.0)
    return np.array(counts, np.int32), indices.astype(np.int32), values.astype(float), y, weight.to_numpy(zero_copy_only=False).astype(float)


def _loss(block: tuple[np.ndarray, ...], w: np.ndarray) -> tuple[float, np.ndarray]:
    counts, indices, values, y, weight = block
    margin = np.bincount(np.repeat(np.arange(len(y)), counts), values * w[indices], len(y)) + w[-1]
    slack = np.maximum(0.0, 1 - y * margin)
    pull = -2 * weight * y * slack
    gradient = np.bincount(indices, values * np.repeat(pull, counts), len(w))
    gradient[-1] += pull.sum()
    return float((weight * slack * slack).sum()), gradient


def _bare(df: DataFrame) -> DataFrame:
    """Each row reaches Python with the schema, so the names of all features must not be part of it."""
    return df.select(F.col("features").alias("features", metadata={}), "label", "weight")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(_block(batch.slice(start, BLOCK)), 5)]}, pa.schema([("block", pa.binary())]))


def minimize(f: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, most: int, tol: float, memory: int = 10) -> tuple[np.ndarray, int]:
    """The least point of a smooth convex function by L-BFGS, and the number of steps; ends at a gradient of ``tol`` times the first."""
    x, (value, g) = start, f(start)
    first, pairs = np.linalg.norm(g), []
    for step in range(most):
        if np.linalg.norm(g) <= tol * max(first, 1e-300):
            return x, step
        direction, kept = -g, []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ direction)
            kept.append(a)
            direction = direction - a * y
        if pairs:
            s, y, _ = pairs[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(pairs, reversed(kept)):
            direction = direction + s * (a - rho * (y @ direction))
        slope = g @ direction
        if slope >= 0:
            direction, slope, pairs = -g, -(g @ g), []
        # a first step of about one unit; halved or doubled until the value falls enough and the slope flattens
        low, high, size = 0.0, np.inf, 1.0 if pairs else 1.0 / max(1.0, np.linalg.norm(g))
        for _ in range(40):
            new, (v, h) = x + size * direction, f(x + size * direction)
            if v > value + 1e-4 * size * slope:
                high = size
            elif h @ direction < 0.9 * slope:
                low = size
            else:
                break
            size = (low + high) / 2 if np.isfinite(high) else 2 * size
        s, y = new - x, h - g
        if v >= value and np.linalg.norm(s) <= 1e-12 * max(1.0, np.linalg.norm(x)):
            return x, step
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs[-(memory - 1) :], (s, y, 1 / (s @ y))]
        x, value, g = new, v, h
    return x, most


class SquaredHingeSVM:
    """An estimator over ``features``, ``label`` (0 or 1) and ``weight``; its model is MLlib's, so that it is saved and applied like others."""

    def __init__(self, C: float = 1.0, maxIter: int = 1000, tol: float = 1e-7):
        self.C, self.maxIter, self.tol = C, maxIter, tol

    def getOrDefault(self, name: str):
        """A setting by name, as of MLlib's estimators."""
        return getattr(self, name)

    def coefficients(self, df: DataFrame) -> tuple[np.ndarray, int]:
        """Weights with the intercept last, and the number of steps."""
        rows = _bare(df)
        first = rows.first()
        if first is None:
            raise RuntimeError("no supervised rows")
        context, size = df.sparkSession.sparkContext, first["features"].size + 1
        packed = rows.select(F.unwrap_udt("features").alias("features"), F.col("label").cast("double"), F.col("weight").cast("double")).mapInArrow(_blocks, "block binary")
        blocks = packed.rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
        depth = 1 if blocks.getNumPartitions() <= AT_ONCE else 2

        def whole(w):
            sent = context.broadcast(w)
            both = lambda a, b: b if a is None else a if b is None else (a[0] + b[0], a[1] + b[1])
            try:
                loss, gradient = blocks.treeAggregate(None, lambda have, b: both(have, _loss(b, sent.value)), both, depth)
            finally:
                sent.unpersist()
            return 0.5 * float(w @ w) + self.C * loss, w + self.C * gradient

        try:
            return minimize(whole, np.zeros(size), self.maxIter, self.tol)
        finally:
            blocks.unpersist()

    def fit(self, df: DataFrame) -> LinearSVCModel:
        w, _ = self.coefficients(df)
        context = df.sparkSession.sparkContext
        java = context._jvm.org.apache.spark.ml.classification.LinearSVCModel
        return LinearSVCModel(java(f"SquaredHingeSVM_{uuid.uuid4().hex[:12]}", _py2java(context, Vectors.dense(w[:-1])), float(w[-1])))
