"""Whitening of embeddings by a covariance from two passes.

An entry c counts as the long x = floor(1024 * c) + 100000, so that sums are exact in any order.

1. Exact sums of x give n and the sum S of each dimension.
2. Each task centres its rows, (n * x - S) / n with an exact numerator, and adds up their outer products by matrix
   products. Partial sums of both passes meet in ``treeAggregate``: a task's part is one matrix of the dimension's
   size, and the driver gets the sum of a few of them.
3. The symmetric eigenproblem is LAPACK's; the leading components are broadcast and rows are projected where they are.
   The covariance of the projections is measured in one more pass.

A row is used if its vector has no null, NaN or infinite entry and 1024 times each entry fits in a long. Defined results:
null and empty vectors, and those of another length than most have (of the greater length where two are as frequent), are
left out; an empty table gives no rows. Components whose eigenvalue is zero to double precision are none: there are
fewer than asked for where the vectors span fewer dimensions, and no rows where all vectors are equal. A component's
largest entry is positive (the first of them in a tie). Repeated ids and null ids are rows like any other; other columns
are left out. A deviation that a long cannot hold is null.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Above this an entry's x does not fit in a long.
LARGEST = 9e15
#: Entries of vectors worked on at once.
TOGETHER = 1 << 20


class Model(NamedTuple):
    n: int
    sums: list[int]
    components: np.ndarray  # a row each
    values: np.ndarray
    trace: float


def usable(df: DataFrame, dimension: int | None = None) -> tuple[DataFrame, int]:
    """The rows (vec_id, vector) that count, their vectors as doubles, and their dimension (0: there is none)."""
    rows = df.select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    rows = rows.where(F.forall("vector", lambda c: F.abs(c) <= LARGEST) & (F.size("vector") > 0))
    if dimension is None:
        most = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("d")).first()
        dimension = most["d"] if most else 0
    return rows.where(F.size("vector") == dimension), dimension


def _matrices(batches, dimension: int):
    """(vec_ids, x) of bounded parts of all batches."""
    for batch in batches:
        step = max(1, TOGETHER // dimension)
        for a in range(0, batch.num_rows, step):
            part = batch.slice(a, step)
            entries = pa.compute.list_flatten(part.column(1)).to_numpy()
            yield part.column(0), np.floor(SCALE * entries).astype(np.int64).reshape(-1, dimension) + OFFSET


def _reduced(rows: DataFrame, dimension: int, start: Callable, add: Callable, merge: Callable):
    """``add`` every part's matrix to what ``start`` gives, a task at a time, and merge the tasks' results in a tree."""

    def run(batches):
        state = start()
        for _, x in _matrices(batches, dimension):
            state = add(state, x)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], ["state"])

    parts = rows.mapInArrow(run, "state binary").rdd
    load = lambda have, row: pickle.loads(row[0]) if have is None else merge(have, pickle.loads(row[0]))
    both = lambda a, b: b if a is None else a if b is None else merge(a, b)
    return parts.treeAggregate(None, load, both)


def exact_sums(rows: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """n and the sums of x by dimension, as integers of any size."""

    def add(state, x):
        low, high = (x & 0xFFFFFFFF).sum(0), (x >> 32).sum(0)
        return state[0] + len(x), [s + (int(h) << 32) + int(k) for s, h, k in zip(state[1], high, low)]

    merge = lambda a, b: (a[0] + b[0], [s + t for s, t in zip(a[1], b[1])])
    return _reduced(rows, dimension, lambda: (0, [0] * dimension), add, merge) or (0, [0] * dimension)


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: longs where they hold it, else Python's integers."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
    if n * most + max(map(abs, sums)) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - S)^2 of each row."""
    d = _numerators(x, n, sums)
    if d.dtype == object or int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] >= 1 << 63:
        found = (d.astype(object) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in found]
    return np.einsum("ij,ij->i", d, d).tolist()


def covariance(rows: DataFrame, dimension: int, n: int, sums: list[int]) -> np.ndarray:
    """Of x over all rows, divisor n."""

    def add(total, x):
        d = centred(x, n, sums)
        return total + d.T @ d

    return _reduced(rows, dimension, lambda: np.zeros((dimension, dimension)), add, lambda a, b: a + b) / n


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Model:
    n, sums = exact_sums(rows, dimension) if dimension else (0, [])
    if not n:
        return Model(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    values, vectors = np.linalg.eigh(covariance(rows, dimension, n, sums))
    values, vectors = values[::-1], vectors[:, ::-1].T
    trace = float(values.sum())
    k = int((values[:components] > 4 * dimension * np.finfo(float).eps * max(trace, 0)).sum()) if trace > 0 else 0
    vectors = vectors[:k]
    largest = np.abs(vectors).argmax(1)
    return Model(n, sums, vectors * np.sign(vectors[np.arange(k), largest])[:, None], values[:k], trace)


def project(x: np.ndarray, model: Model) -> np.ndarray:
    return centred(x, model.n, model.sums) @ (model.components / np.sqrt(model.values)[:, None]).T


def identity_error(rows: DataFrame, dimension: int, model: Model) -> float:
    """The largest entry of the projections' covariance minus the identity; parts are centred on their own means."""

    def add(state, x):
        z = project(x, model)
        mean = z.mean(0)
        return merge(state, (len(z), mean, (z - mean).T @ (z - mean)))

    def merge(a, b):
        n = a[0] + b[0]
        if not n:
            return a
        apart = b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)

    k = len(model.values)
    n, _, products = _reduced(rows, dimension, lambda: (0, np.zeros(k), np.zeros((k, k))), add, merge)
    return float(np.abs(products / n - np.eye(k)).max())


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, components: int = COMPONENTS, dimension: int | None = None) -> DataFrame:
    """One row for each usable row of (vec_id, vector) and component."""
    spark = df.sparkSession
    rows, dimension = usable(df.select(F.col("vec_id").cast("long"), "vector"), dimension)
    model = fit(rows, dimension, components)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(rows, dimension, model)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for ids, x in _matrices(batches, dimension):
            z = project(x, m)
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(deviations(x, m.n, m.sums), pa.int64())
            columns = [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), m.n)), deviation.take(pa.array(each))]
            columns += [pa.array(z.ravel()), pa.array(np.tile(m.values / m.trace, len(x))), pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)
