"""Gradient boosting over few features, grown level by level from histograms of which each partition sends one.

The trees are those of MLlib's GBTClassifier: logistic loss, variance as impurity, at most 32 bins of about equal weight, a first tree of
weight 1; where splits gain the same, MLlib's choice is up to rounding and here the first is taken. MLlib takes two stages a level; here a partition's rows are one matrix of bin numbers with the margins so far, a level
is one stage, and what comes back from a partition is a sum for each open node and bin.
"""

from __future__ import annotations

from functools import reduce
from itertools import batched

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.storage import remove, shared_dir
from lakemill.operators.trees import BINS, MOST_FEATURES, ForestModel, _bare, _Nodes

#: Rows of a partition at least and at most; rows from which MLlib makes the bins.
LEAST_ROWS, MOST_ROWS, FEW_ROWS = 32_768, 262_144, 10_000

#: Rounds after which the lineage is cut; partitions from which sums are added up before they reach the driver.
CUT_ROUNDS, MANY_PARTS = 20, 32

#: Gains that differ by less, as a share of the sums they come from, are ties, and the first one wins.
TIE = 1e-12


def _between(values: np.ndarray, weights: np.ndarray, total: float) -> np.ndarray:
    """MLlib's rule: all midpoints if there are few values, else those next to each 32nd of the weight ``total``; zeros have what others leave of it."""
    some = values != 0
    values, weights = values[some], weights[some]
    rest = total - weights.sum()
    if rest > np.finfo(float).eps * 100 * len(values) ** 2:
        values, weights = np.append(values, 0.0), np.append(weights, rest)
    values, at = np.unique(values, return_inverse=True)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < BINS:
        return middle
    reached = np.cumsum(np.bincount(at, weights))
    target = stride = total / BINS
    made = []
    for k in range(len(middle)):
        if abs(reached[k] - target) < abs(reached[k + 1] - target):
            made.append(middle[k])
            target += stride
    return np.array(made)


def thresholds(rows: DataFrame, n: int, size: int, seed: int) -> list[np.ndarray]:
    """Of each feature the values between its bins, from the rows that MLlib takes for them: all up to 10,000, about as many beyond."""
    share = min(1.0, FEW_ROWS / n)
    if share < 1:
        spark = rows.sparkSession
        drawn = rows._jdf.javaRDD().sample(False, share, spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        few = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark).collect()
    else:
        few = rows.collect()
    total = share * rows.agg(F.sum("weight")).first()[0]
    dense, weights = np.array([r["features"].toArray() for r in few]), np.array([r["weight"] for r in few])
    return [_between(dense[:, k], weights, total) for k in range(size)]


class _Rows:
    """A partition's rows: bin numbers by feature, labels -1 and 1, weights and margins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, margin: np.ndarray):
        self.x, self.y, self.weight, self.margin = x, y, weight, margin

    @classmethod
    def of(cls, rows, cuts: list[np.ndarray]) -> _Rows:
        """From (array of features, label, weight)."""
        x, rest = [np.empty((len(cuts), 0), np.uint8)], [np.empty((0, 2))]
        for some in batched(rows, 10_000):
            dense = np.array([r[0] for r in some])
            x.append(np.stack([np.searchsorted(c, dense[:, k], side="left") for k, c in enumerate(cuts)]).astype(np.uint8))
            rest.append(np.array([r[1:] for r in some], float))
        rest = np.concatenate(rest)
        return cls(np.concatenate(x, axis=1), np.where(rest[:, 0] > 0, 1.0, -1.0), rest[:, 1].copy(), np.zeros(len(rest)))

    def nodes(self, tree: tuple, depth: int) -> np.ndarray:
        """The number of the node that each row has reached after so many levels."""
        feature, bin_, left = tree
        n, leaf = len(self.y), feature < 0
        start, last, left = np.where(leaf, 0, feature * n), np.where(leaf, 255, bin_), np.where(leaf, np.arange(len(left)), left)
        at, row, flat = np.zeros(n, np.int64), np.arange(n), self.x.ravel()
        for _ in range(depth):
            at = left[at] + (flat[start[at] + row] > last[at])
        return at

    def moved(self, tree: tuple, value: np.ndarray, depth: int) -> _Rows:
        """With the tree's values added to the margins."""
        return _Rows(self.x, self.y, self.weight, self.margin + value[self.nodes(tree, depth)])

    def sums(self, tree: tuple, depth: int, slots: np.ndarray, n: int, bins: list[int], first: bool) -> np.ndarray:
        """Weights and weighted residuals by open node and bin; ``slots`` numbers the ``n`` open nodes, and is ``n`` for others."""
        residual = self.y if first else 4 * self.y / (1 + np.exp(2 * self.y * self.margin))
        slot, weighted = slots[self.nodes(tree, depth)], self.weight * residual
        made = np.empty((n, sum(bins), 2))
        for k, (b, end) in enumerate(zip(bins, np.cumsum(bins))):
            code = slot * b + self.x[k]
            for i, w in enumerate((self.weight, weighted)):
                made[:, end - b : end, i] = np.bincount(code, w, (n + 1) * b)[: n * b].reshape(n, b)
        return made


def _best(sums: np.ndarray, bins: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each node the best feature, its last bin on the left, whether that split gains, and the sums of both sides."""
    full = np.zeros((len(sums), len(bins), max(2, *bins), 2))
    full[:, np.repeat(np.arange(len(bins)), bins), np.concatenate([np.arange(b) for b in bins])] = sums
    left = np.cumsum(full, axis=2)[:, :, :-1]
    right = np.cumsum(full[:, :, ::-1], axis=2)[:, :, -2::-1]  # not by subtraction, so that nothing stays exactly zero
    both = _score(left) + _score(right)
    gain = np.where((left[..., 0] > 0) & (right[..., 0] > 0), both - _score(left[:, :, :1] + right[:, :, :1]), -np.inf).reshape(len(sums), -1)
    n, both = np.arange(len(sums)), both.reshape(len(sums), -1)
    top = gain.argmax(axis=1)
    noise = TIE * both[n, top]
    at = (gain >= (gain[n, top] - noise)[:, None]).argmax(axis=1)
    k, b = at // left.shape[2], at % left.shape[2]
    return k, b, gain[n, at] > noise, left[n, k, b], right[n, k, b]


def _score(s: np.ndarray) -> np.ndarray:
    """The squared sum by the weight, which is what a split raises as it lowers the variance."""
    return np.divide(s[..., 1] ** 2, s[..., 0], out=np.zeros(s.shape[:-1]), where=s[..., 0] > 0)


class BoostingModel(ForestModel):
    """The trees of a forest, whose values add up to a row's margin."""

    def _outcome(self, total: Column) -> dict[str, Column]:
        p = 1 / (1 + F.exp(-2 * total))
        return {"rawPrediction": array_to_vector(F.array(-total, total)), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (total > 0).cast("double")}


class Boosting:
    """Boosted trees over ``features``, ``label`` (0 or 1) and ``weight``."""

    def __init__(self, maxIter: int, stepSize: float, maxDepth: int, seed: int):
        self.maxIter, self.stepSize, self.maxDepth, self.seed = maxIter, stepSize, maxDepth, seed

    def getOrDefault(self, name: str):
        """A setting by name, as of MLlib's estimators."""
        return getattr(self, name)

    def fit(self, df: DataFrame):
        rows = _bare(df)
        first = rows.first()
        if first is None:
            raise RuntimeError("no supervised rows")
        size = first["features"].size
        if not 0 < size <= MOST_FEATURES:  # wider vectors stay sparse in MLlib
            return GBTClassifier(weightCol="weight", maxIter=self.maxIter, stepSize=self.stepSize, maxDepth=self.maxDepth, seed=self.seed).fit(df)
        n, context = rows.count(), df.sparkSession.sparkContext
        cuts = thresholds(rows, n, size, self.seed)
        parts = max(min(context.defaultParallelism, -(-n // LEAST_ROWS)), -(-n // MOST_ROWS))
        sent = context.broadcast(cuts)
        arrays = rows.select(vector_to_array("features"), "label", "weight").repartition(parts)
        state = arrays.rdd.mapPartitions(lambda part: [_Rows.of(part, sent.value)]).persist(StorageLevel.MEMORY_AND_DISK)
        return BoostingModel.of([(nodes, 1) for nodes in self._rounds(df, state, [len(c) + 1 for c in cuts])], cuts)

    def _rounds(self, df: DataFrame, state: RDD, bins: list[int]) -> list[_Nodes]:
        """All trees, with values as they are added to the margin."""
        if not state.context.getCheckpointDir():
            state.context.setCheckpointDir(shared_dir(df.sparkSession))
        made, before, file, depth = [], None, None, self.maxDepth
        try:
            for t in range(self.maxIter):
                nodes = self._grow(state, bins, before, not t)
                nodes.value *= self.stepSize if t else 1.0
                made.append(nodes)
                if t % CUT_ROUNDS == 0 and t:  # the state's first job has written it
                    old, file = file, state.getCheckpointFile()
                    if old:
                        remove(df.sparkSession, old)
                before, state = state, state.map(lambda s, tree=_arrays(nodes), value=nodes.value: s.moved(tree, value, depth)).persist(StorageLevel.MEMORY_AND_DISK)
                if (t + 1) % CUT_ROUNDS == 0:
                    state.checkpoint()
        finally:
            for kept in (before, state):
                if kept is not None:
                    kept.unpersist()
            if file:
                remove(df.sparkSession, file)
        return made

    def _grow(self, state: RDD, bins: list[int], before: RDD | None, first: bool) -> _Nodes:
        """One tree; ``before`` is let go once the state that was made from it is there."""
        nodes, open_ = _Nodes(np.zeros(1)), np.zeros(1, int)
        for depth in range(self.maxDepth):
            n, tree, slots = len(open_), _arrays(nodes), np.full(len(nodes.feature), len(open_))
            slots[open_] = np.arange(n)
            sums = state.map(lambda s: s.sums(tree, depth, slots, n, bins, first))
            sums = sums.treeReduce(np.add) if state.getNumPartitions() > MANY_PARTS else reduce(np.add, sums.collect())
            if before is not None:
                before = before.unpersist() and None
            k, b, good, left, right = _best(sums, bins)
            if depth == 0:
                root = sums[0, : bins[0]].sum(axis=0)
                nodes.value[0] = root[1] / root[0]
            sides = np.stack([left, right], axis=1)[good]
            open_ = nodes.split(open_[good], k[good], b[good], sides[..., 1] / sides[..., 0]).ravel()
            if not len(open_):
                break
        return nodes


def _arrays(nodes: _Nodes) -> tuple:
    return nodes.feature, nodes.bin, nodes.left
