"""The forest from histograms: closed nodes cost nothing, sizes of the work change no tree, models are saved like others."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from lakemill.operators import models, trees


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=600), rng.integers(0, 3, 600), rng.random(600), rng.integers(0, 2, 600)])
    y = (x[:, 0] + x[:, 1] > 1) ^ (rng.random(600) < 0.05)
    rows = spark.createDataFrame([(Vectors.dense(r), float(k), 2.0 if k else 0.7) for r, k in zip(x, y)], ["features", "label", "weight"]).cache()
    return rows, x, y


def state(model):
    return [a.tolist() for a in model._state()]


def test_pairs_of_leaves_are_not_passed_on():
    block = trees._Block(0, [(Vectors.dense([v]), v > 2, 1.0) for v in range(6)], [np.array([0.5, 2.5])])
    pairs = trees._Pairs.drawn_by(block, range(8), 42)
    assert pairs.drawn.sum() > 20 and set(pairs.node) <= set(range(8))
    children = np.full((8, 2), -1)
    children[3, 1] = 0
    moved = pairs.moved(np.zeros(8, int), np.zeros(8, int), children)
    assert set(moved.node) <= {0} and len(moved.row) == int(((pairs.node == 3) & (pairs.row > 0)).sum())


def test_best_split_against_all_splits():
    rng = np.random.default_rng(2)
    sums = rng.integers(0, 4, (5, 3, trees.BINS, 2)).astype(float)
    sums[:, :, :, :] *= (rng.random((1, 1, trees.BINS, 1)) < 0.4)
    sums[:, 1:, :, :] = sums[:, :1][:, :, rng.permutation(trees.BINS)]  # all features of a node have the same rows
    gini = lambda s: s.sum() and s.sum() * (1 - ((s / s.sum()) ** 2).sum())
    for n, (k, b, gain, left, right) in enumerate(zip(*trees._best(sums))):
        plain = {(i, j): gini(sums[n, i].sum(0)) - gini(sums[n, i, : j + 1].sum(0)) - gini(sums[n, i, j + 1 :].sum(0)) for i in range(3) for j in range(trees.BINS - 1)}
        assert abs(gain - max(plain.values())) < 1e-9 and abs(plain[k, b] - gain) < 1e-9
        assert (left == sums[n, k, : b + 1].sum(0)).all() and (right == sums[n, k, b + 1 :].sum(0)).all()


def test_forest_learns_and_sizes_of_work_change_no_tree(made, monkeypatch, tmp_path):
    rows, x, y = made
    model = trees.Forest(12, 30, 42).fit(rows)
    assert len(model.roots) == 12 and ((model.sums(x) / 12 > 0.5) == (y > 0)).mean() > 0.95
    monkeypatch.setattr(trees, "NODES", 5)
    assert state(trees.Forest(12, 30, 42).fit(rows)) == state(model)
    out = model.transform(rows).collect()
    assert np.allclose([r["probability"][1] for r in out], model.sums(x) / 12) and all(r["prediction"] == (r["probability"][1] > 0.5) for r in out)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    assert state(PipelineModel.load(str(tmp_path / "m")).stages[0]) == state(model)


def test_depth_and_groups_of_trees_and_wide_rows(spark, made, monkeypatch):
    rows, x, y = made
    assert len(trees.Forest(3, 1, 42).fit(rows).feature) == 9
    monkeypatch.setattr(trees, "PAIRS", 1200)
    assert len(trees.Forest(5, 30, 42).fit(rows).roots) == 5
    one = rows.where("label = 1")
    model = trees.Forest(2, 30, 42).fit(one)
    assert model.value.tolist() == [1.0, 1.0] and models.ESTIMATORS["url_forest"](1).numTrees == 300
    monkeypatch.setattr(trees, "MOST_FEATURES", 3)
    assert trees.Forest(2, 3, 42).fit(rows).getNumTrees == 2
