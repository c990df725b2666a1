"""Boosting from histograms: MLlib's scores with half its stages, whatever the sizes of the work."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lakemill.operators import boosting, models


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 3, 900), rng.random(900), rng.integers(0, 2, 900), np.zeros(900)])
    y = (x[:, 0] + x[:, 1] > 1) ^ (rng.random(900) < 0.2)
    rows = spark.createDataFrame([(Vectors.dense(r), float(k), float((2.0 if k else 0.7) * (1 + w))) for r, k, w in zip(x, y, rng.random(900))], ["features", "label", "weight"]).cache()
    return rows, x


def outcome(model, rows):
    return np.array([[*r["rawPrediction"], *r["probability"], r["prediction"]] for r in model.transform(rows).collect()])


def test_scores_are_mllibs(made):
    rows, _ = made
    plain = GBTClassifier(weightCol="weight", maxIter=12, stepSize=0.05, maxDepth=6, seed=42).fit(rows)
    assert np.abs(outcome(plain, rows) - outcome(boosting.Boosting(12, 0.05, 6, 42).fit(rows), rows)).max() < 1e-9


def test_a_level_is_one_stage(spark, made):
    rows, _ = made
    estimator = models.ESTIMATORS["gradient_boosting"](900)
    stages = {}
    for rounds in (2, 10):
        estimator.maxIter = rounds
        spark.sparkContext.setJobGroup(f"boosting-{rounds}", "")
        estimator.fit(rows)
        tracker = spark.sparkContext.statusTracker()
        infos = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"boosting-{rounds}") for s in tracker.getJobInfo(j).stageIds]
        stages[rounds] = sum(bool(i and i.numCompletedTasks) for i in infos)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages[10] - stages[2] <= 8 * 6


def test_sizes_of_work_change_no_score(spark, made, monkeypatch, tmp_path):
    rows, x = made
    model = boosting.Boosting(7, 0.05, 6, 42).fit(rows)
    for name, value in (("LEAST_ROWS", 250), ("MANY_PARTS", 1), ("CUT_ROUNDS", 2)):
        monkeypatch.setattr(boosting, name, value)
    other = boosting.Boosting(7, 0.05, 6, 42).fit(rows)
    assert (other.feature == model.feature).all() and (other.threshold == model.threshold).all() and np.abs(other.value - model.value).max() < 1e-12
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    assert not list(folder.glob("rdd-*/part-*"))
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert (outcome(loaded, rows) == outcome(model, rows)).all() and np.allclose(outcome(model, rows)[:, 1], model.sums(x))


def test_bins_of_many_rows_are_mllibs(spark):
    x = [F.randn(1), F.rand(2) * 50, (F.rand(3) < 0.3).cast("double"), F.lit(0.0)]
    rows = spark.range(0, 15_000, 1, 3).select(array_to_vector(F.array(*x)).alias("features"), (F.rand(4) < 0.4).cast("double").alias("label"), (F.rand(5) + 0.5).alias("weight")).cache()
    plain = GBTClassifier(weightCol="weight", maxIter=3, stepSize=0.05, maxDepth=6, seed=42).fit(rows)
    assert np.abs(outcome(plain, rows) - outcome(boosting.Boosting(3, 0.05, 6, 42).fit(rows), rows)).max() < 1e-9


def test_one_class_and_wide_rows(made, monkeypatch):
    rows, _ = made
    model = boosting.Boosting(3, 0.05, 6, 42).fit(rows.where("label = 1"))
    assert len(model.feature) == 3 and (outcome(model, rows)[:, 4] == 1).all()
    assert boosting._best(np.array([[[2.0, 1.0]]]), [1])[2].tolist() == [False]
    monkeypatch.setattr(boosting, "MOST_FEATURES", 3)
    assert isinstance(boosting.Boosting(2, 0.05, 3, 42).fit(rows), GBTClassificationModel)
