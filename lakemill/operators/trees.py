"""Forests over few features, grown level by level from histograms that the cluster adds up.

MLlib passes every row to every tree at every level. Here each partition's rows are one matrix of bin numbers, and of a
forest only the pairs of row and tree whose node is still open are passed on to the next level. Bins, impurity and stop rules are MLlib's:
32 bins, Gini impurity, splits that gain, the root of the number of features for each node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BINS = 32

#: Wider vectors go to MLlib, which keeps them sparse.
MOST_FEATURES = 256

#: Rows of a partition at least and at most, and partitions between the two; pairs of row and tree that are grown at once; nodes of one histogram.
LEAST_ROWS, MOST_ROWS, PARTS, PAIRS, NODES = 4096, 65_536, 24, 200_000_000, 4096


def thresholds(rows: DataFrame, size: int) -> list[np.ndarray]:
    """Of each feature at most 31 values between its bins: all midpoints where it has few values, else by quantiles."""
    steps = 1024
    values = rows.select(F.posexplode(vector_to_array("features")).alias("k", "v"))
    found = {r["k"]: r["q"] for r in values.groupBy("k").agg(F.percentile_approx("v", [i / steps for i in range(steps + 1)], 10_000).alias("q")).collect()}
    made = []
    for k in range(size):
        few = np.unique(found[k])
        if len(few) > BINS:
            few = np.unique(np.array(found[k])[steps // BINS // 2 :: steps // BINS])
        made.append((few[:-1] + few[1:]) / 2)
    return made


class _Block:
    """A partition's rows as bin numbers, with labels and weights."""

    def __init__(self, part: int, rows: list, cuts: list[np.ndarray]):
        self.part = part
        dense = np.array([r[0].toArray() for r in rows])
        self.x = np.column_stack([np.searchsorted(c, dense[:, k], side="left") for k, c in enumerate(cuts)]).astype(np.uint8)
        self.y = np.array([r[1] for r in rows]) > 0
        self.weight = np.array([r[2] for r in rows], float)


def _blocks(df: DataFrame, cuts: list[np.ndarray], parts: int) -> RDD:
    sent = df.sparkSession.sparkContext.broadcast(cuts)

    def of(part, rows):
        rows = list(rows)
        return [_Block(part, rows, sent.value)] if rows else []

    return df.repartition(parts).rdd.mapPartitionsWithIndex(of).persist(StorageLevel.MEMORY_AND_DISK)


def _bare(df: DataFrame) -> DataFrame:
    """Each row reaches Python with the schema, so the names of all features must not be part of it."""
    return df.select(F.col("features").alias("features", metadata={}), "label", "weight")


class _Pairs:
    """The pairs of a block's rows and trees whose nodes are open: the row, how often the tree drew it, and the node's number."""

    def __init__(self, block: _Block, row: np.ndarray, drawn: np.ndarray, node: np.ndarray):
        self.block, self.row, self.drawn, self.node = block, row, drawn, node

    @classmethod
    def drawn_by(cls, block: _Block, trees: range, seed: int) -> _Pairs:
        rows, drawn = [], []
        for t in trees:
            count = np.random.default_rng([seed, t, block.part]).poisson(1.0, len(block.y))
            rows.append(np.flatnonzero(count).astype(np.int32))
            drawn.append(count[rows[-1]].astype(np.uint8))
        node = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        return cls(block, np.concatenate(rows), np.concatenate(drawn), node)

    def moved(self, feature: np.ndarray, bin_: np.ndarray, children: np.ndarray) -> _Pairs:
        """After splits; a child numbered -1 is a leaf, and its pairs are left out."""
        right = self.block.x[self.row, feature[self.node]] > bin_[self.node]
        node = children[self.node, right.astype(np.int8)]
        keep = np.flatnonzero(node >= 0)
        keep = keep[np.argsort(node[keep], kind="stable")] if len(children) > NODES // 2 else keep
        return _Pairs(self.block, self.row[keep], self.drawn[keep], node[keep])

    def histograms(self, features: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Weights by node, feature, bin and class, ``NODES`` nodes at a time; ``features`` are those of each node."""
        n, m = features.shape
        for low in range(0, n, NODES):
            high = min(n, low + NODES)
            if n > NODES:  # sorted by node then
                at = slice(*np.searchsorted(self.node, [low, high]))
            else:
                at = slice(None)
            row, node = self.row[at], self.node[at]
            if not len(row):
                continue
            weight, made = self.drawn[at] * self.block.weight[row], np.zeros((high - low, m, BINS * 2))
            base = (node - low).astype(np.int64) * (BINS * 2) + self.block.y[row]
            for k in range(m):
                code = base + self.block.x[row, features[node, k]].astype(np.int64) * 2
                made[:, k] = np.bincount(code, weight, (high - low) * BINS * 2).reshape(high - low, BINS * 2)
            yield low, made.reshape(high - low, m, BINS, 2)


def _best(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each node the best feature (by position), its last bin on the left, the gain, and the sums of both sides."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    right = np.cumsum(sums[:, :, ::-1], axis=2)[:, :, -2::-1]  # not by subtraction, so that nothing stays exactly zero
    gain = _gini(left) + _gini(right) - _gini(left[:, :, :1] + right[:, :, :1])
    gain = np.where((left.sum(-1) > 0) & (right.sum(-1) > 0), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    k, b, n = at // (BINS - 1), at % (BINS - 1), np.arange(len(at))
    return k, b, flat[n, at], left[n, k, b], right[n, k, b]


def _gini(s: np.ndarray) -> np.ndarray:
    """The weight less its Gini impurity; ``s`` ends in weights by class."""
    return np.divide((s * s).sum(-1), s.sum(-1), out=np.zeros(s.shape[:-1]), where=s.sum(-1) > 0)


class _Nodes:
    """Growing tables of nodes; a leaf has feature -1. Children are numbered in this table."""

    def __init__(self, value: np.ndarray):
        n = len(value)
        self.feature, self.bin, self.left, self.value = np.full(n, -1), np.zeros(n, int), np.full(n, -1), np.asarray(value, float)

    def split(self, at: np.ndarray, feature: np.ndarray, bin_: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Split the nodes ``at``; ``values`` are those of left and right children, whose numbers are returned."""
        first = len(self.feature) + 2 * np.arange(len(at))
        self.feature[at], self.bin[at], self.left[at] = feature, bin_, first
        more = 2 * len(at)
        self.feature, self.bin, self.left = (np.append(a, np.full(more, v)) for a, v in ((self.feature, -1), (self.bin, 0), (self.left, -1)))
        self.value = np.append(self.value, values.ravel())
        return np.stack([first, first + 1], axis=1)


class ForestModel(Model, MLWritable, MLReadable):
    """Trees as one table of nodes with the share of class 1; a leaf has feature -1, and the right child follows the left one."""

    def __init__(self, roots=(), feature=(), threshold=(), left=(), value=()):
        super().__init__()
        self.roots = np.asarray(roots, np.int64)
        self.feature, self.left = np.asarray(feature, np.int64), np.asarray(left, np.int64)
        self.threshold, self.value = np.asarray(threshold, float), np.asarray(value, float)

    @classmethod
    def of(cls, grown: list[tuple[_Nodes, int]], cuts: list[np.ndarray]) -> ForestModel:
        """From tables of nodes and how many of their first nodes are roots."""
        starts = np.cumsum([0, *[len(n.feature) for n, _ in grown]])
        put = lambda of: np.concatenate([of(n, s) for (n, _), s in zip(grown, starts)])
        feature, bin_ = put(lambda n, _: n.feature), put(lambda n, _: n.bin)
        threshold = np.array([cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature, bin_)])
        roots = np.concatenate([s + np.arange(k) for (_, k), s in zip(grown, starts)])
        return cls(roots, feature, threshold, put(lambda n, s: np.where(n.left >= 0, n.left + s, -1)), put(lambda n, _: n.value))

    def sums(self, dense: np.ndarray) -> np.ndarray:
        """The values of the leaves that each row reaches, added up."""
        total = np.zeros(len(dense))
        for root in self.roots:
            at, moving = np.full(len(dense), root), np.arange(len(dense))
            while len(moving := moving[self.feature[at[moving]] >= 0]):
                here = at[moving]
                at[moving] = self.left[here] + (dense[moving, self.feature[here]] > self.threshold[here])
            total += self.value[at]
        return total

    def _transform(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast(self._state())

        @F.pandas_udf("double")
        def summed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = ForestModel(*sent.value)
            for s in batches:
                yield pd.Series(model.sums(np.stack(s.to_numpy())) if len(s) else [], dtype=float)

        df = df.withColumn("__sum", summed(vector_to_array("features")))
        return df.withColumns(self._outcome(F.col("__sum"))).drop("__sum")

    def _outcome(self, total: Column) -> dict[str, Column]:
        """The columns that MLlib's classifiers add; of two classes the first wins ties."""
        trees = F.lit(float(len(self.roots)))
        p = total / trees
        return {"rawPrediction": array_to_vector(F.array(trees - total, total)), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (p > 0.5).cast("double")}

    def _state(self) -> tuple:
        return self.roots, self.feature, self.threshold, self.left, self.value

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, m = SparkSession.getActiveSession(), self.model
        DefaultParamsWriter.saveMetadata(m, path, spark)
        root = np.isin(np.arange(len(m.feature)), m.roots)
        nodes = pd.DataFrame({"node": np.arange(len(m.feature)), "root": root, "feature": m.feature, "threshold": m.threshold, "left": m.left, "value": m.value})
        spark.createDataFrame(nodes).write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def __init__(self, kind: type[ForestModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values("node")
        model = self.kind(nodes["node"][nodes["root"]], nodes["feature"], nodes["threshold"], nodes["left"], nodes["value"])
        return model._resetUid(metadata["uid"])


class Forest:
    """A random forest over ``features``, ``label`` (0 or 1) and ``weight``."""

    def __init__(self, numTrees: int, maxDepth: int, seed: int):
        self.numTrees, self.maxDepth, self.seed = numTrees, maxDepth, seed

    def getOrDefault(self, name: str):
        """A setting by name, as of MLlib's estimators."""
        return getattr(self, name)

    def setNumTrees(self, n: int) -> Forest:
        self.numTrees = n
        return self

    def fit(self, df: DataFrame):
        rows = _bare(df)
        first = rows.first()
        if first is None:
            raise RuntimeError("no supervised rows")
        size = first["features"].size
        if size > MOST_FEATURES:
            return RandomForestClassifier(weightCol="weight", numTrees=self.numTrees, maxDepth=self.maxDepth, seed=self.seed, cacheNodeIds=True).fit(df)
        n, cuts = rows.count(), thresholds(rows, size)
        blocks = _blocks(rows, cuts, max(min(PARTS, -(-n // LEAST_ROWS)), -(-n // MOST_ROWS)))
        at_once = max(1, PAIRS // n)
        try:
            grown = [self._grow(blocks, range(t, min(self.numTrees, t + at_once)), size) for t in range(0, self.numTrees, at_once)]
        finally:
            blocks.unpersist()
        return ForestModel.of(grown, cuts)

    def _grow(self, blocks: RDD, trees: range, size: int) -> tuple[_Nodes, int]:
        """All nodes of these trees; the first ones are their roots."""
        context, seed = blocks.context, self.seed
        rng, m = np.random.default_rng([seed, trees.start]), int(np.ceil(np.sqrt(size)))
        nodes, open_ = _Nodes(np.zeros(len(trees))), np.arange(len(trees))
        pairs, before = blocks.map(lambda b: _Pairs.drawn_by(b, trees, seed)).persist(StorageLevel.MEMORY_AND_DISK), []
        for depth in range(self.maxDepth):
            features = np.argsort(rng.random((len(open_), size)), axis=1)[:, :m].astype(np.int16)
            sent = context.broadcast(features)
            chunks = -(-len(open_) // NODES)
            sums = pairs.flatMap(lambda p: p.histograms(sent.value)).reduceByKey(np.add, min(chunks, blocks.getNumPartitions()))
            found = sorted(sums.mapValues(lambda s: (_best(s), s[:, 0].sum(axis=1))).collect())
            k, b, gain, left, right, total = (np.concatenate(x) for x in zip(*[(*best, total) for _, (best, total) in found]))
            sent.unpersist()
            while before:
                before.pop().unpersist()
            if depth == 0:
                nodes.value[: len(trees)] = total[:, 1] / total.sum(axis=1)
            good = np.flatnonzero(gain > 1e-12 * total.sum(axis=1))
            sides = np.stack([left[good], right[good]], axis=1)
            feature = features[np.arange(len(open_)), k].astype(np.int64)
            made = nodes.split(open_[good], feature[good], b[good], sides[..., 1] / sides.sum(-1))
            mixed = (sides > 0).all(-1)
            children = np.full((len(open_), 2), -1, np.int32)
            numbers = np.where(mixed, np.cumsum(mixed.ravel()).reshape(mixed.shape) - 1, -1)
            children[good] = numbers
            open_ = made[mixed]
            if not len(open_):
                break
            sent_splits = context.broadcast((feature, b, children))
            before.append(pairs)  # kept until the next level's sums are there
            pairs = pairs.map(lambda p, s=sent_splits: p.moved(*s.value)).persist(StorageLevel.MEMORY_AND_DISK)
        for p in (*before, pairs):
            p.unpersist()
        return nodes, len(trees)
