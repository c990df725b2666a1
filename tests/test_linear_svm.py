"""The squared-hinge machine against Newton's method on dense rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from lakemill.operators import linear_svm, models
from lakemill.operators.linear_svm import SquaredHingeSVM, minimize


def newton(x, y, s, c):
    """Weights with the intercept last, to machine precision."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(200):
        slack = np.maximum(0, 1 - y * (x @ w))
        on = slack > 0
        g = w - 2 * c * x.T @ (s * y * slack)
        step = np.linalg.solve(np.eye(len(w)) + 2 * c * (x[on].T * s[on]) @ x[on], g)
        f = lambda v: 0.5 * v @ v + c * (s * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
        t = 1.0
        while f(w - t * step) > f(w) - 1e-4 * t * g @ step and t > 1e-9:
            t /= 2
        w = w - t * step
        if np.linalg.norm(g) < 1e-10:
            break
    return w


def made(seed, n=300, d=25):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * (rng.random((n, d)) < 0.3)
    y = np.where(x @ rng.normal(size=d) + rng.normal(size=n) > 0.3, 1.0, -1.0)
    return x, y, np.where(y > 0, 1.7, 0.6)


def frame(spark, x, y, s, dense=False):
    vector = lambda r: Vectors.dense(r) if dense else Vectors.sparse(len(r), np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist())
    rows = [(vector(r), float(k > 0), float(w)) for r, k, w in zip(x, y, s)]
    return spark.createDataFrame(rows, ["features", "label", "weight"])


@pytest.mark.parametrize("c", [0.1, 1.0, 20.0])
def test_weights_equal_newtons(spark, monkeypatch, c):
    monkeypatch.setattr(linear_svm, "BLOCK", 37)
    x, y, s = made(int(c * 10))
    w, steps = SquaredHingeSVM(C=c).coefficients(frame(spark, x, y, s, dense=c == 1.0).repartition(5))
    assert np.abs(w - newton(x, y, s, c)).max() < 1e-4 and steps < 200


def test_model_is_applied_saved_and_read(spark, tmp_path):
    x, y, s = made(3, 120, 8)
    df = frame(spark, x, y, s).repartition(3)
    model = SquaredHingeSVM().fit(df)
    want = newton(x, y, s, 1.0)
    got = [(r["rawPrediction"][1], r["prediction"], r["features"].toArray()) for r in model.transform(df).collect()]
    assert all(abs(v @ want[:-1] + want[-1] - raw) < 1e-3 and (raw > 0) == (p > 0) for raw, p, v in got)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    assert np.allclose(again.coefficients.toArray(), model.coefficients.toArray()) and again.intercept == model.intercept


def test_separable_rows_and_no_rows(spark):
    df = frame(spark, np.array([[1.0, 0], [0, 1.0]] * 5), np.array([1.0, -1.0] * 5), np.ones(10))
    assert [r["prediction"] for r in SquaredHingeSVM().fit(df).transform(df).collect()] == [1.0, 0.0] * 5
    with pytest.raises(RuntimeError):
        SquaredHingeSVM().fit(df.limit(0))
    assert isinstance(models.ESTIMATORS["linear_svm"](10), SquaredHingeSVM)


def test_minimize_on_a_quadratic():
    a = np.diag([1.0, 50.0, 3000.0])
    x, steps = minimize(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(3), 200, 1e-10)
    assert np.allclose(x, 1 / np.diag(a)) and steps < 60


def test_features_are_not_named_in_metadata(spark):
    from lakemill.operators import linear_svm, models

    df = spark.createDataFrame([(i, float(i % 2), 1.0, [f"t{i}", f"t{i // 2}", "a" if i % 2 else "b"]) for i in range(40)], "sample_id int, label double, weight double, terms array<string>")
    ready = models.Featurizer("tfidf", min_df=1.0).fit(df).transform(df)
    assert len(ready.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})) == 0
    named = ready.withMetadata("features", {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": f"n{i}"} for i in range(50)]}}})
    assert not linear_svm._bare(named).schema["features"].metadata


def test_terms_are_counted_as_by_mllib(spark):
    from pyspark.ml.feature import IDF, CountVectorizer

    texts = ["a a b", "a b c c", "b d", "", "c c c a e", "d \n d"]
    df = spark.createDataFrame([(t.split(" "),) for t in texts], "terms array<string>").repartition(3)
    theirs = CountVectorizer(inputCol="terms", outputCol="tf", minDF=2.0).fit(df)
    idf = dict(zip(theirs.vocabulary, IDF(inputCol="tf", outputCol="x").fit(theirs.transform(df)).idf.toArray() + 1))
    model, ours = models.counted_terms(df, 100, 2.0)
    assert dict(zip(model.vocabulary, ours)) == pytest.approx(idf)
    assert model.vocabulary == ["c", "a", "b", "d"]  # 5, 4, 3 and 3
    assert models.counted_terms(df, 2, 2.0)[0].vocabulary == model.vocabulary[:2]


def test_terms_come_after_the_split(spark, monkeypatch):
    """They are many times the text's size, so neither the join nor the ranks may move them."""
    from lakemill.plans import learning

    seen = []
    monkeypatch.setattr(learning.splits, "stratified", lambda df, *a: seen.append(df.columns) or df.limit(0))
    monkeypatch.setattr(learning, "cut", lambda df, name: seen.append(df.columns) or (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        learning.ml_text_tfidf_svm(spark, "/root/testdata/sf0.001")
    assert "terms" not in seen[0] and "terms" in seen[1]


def test_word_grams_with_few_words_and_none(spark):
    from pyspark.sql import functions as F

    from lakemill.functions.text import word_grams

    rows = [(None,), ([],), (["a"],), (["a", "b"],), (["a", "", "c"],)]
    got = [r[0] for r in spark.createDataFrame(rows, "t array<string>").coalesce(1).select(word_grams(F.col("t"), (1, 2, 3))).collect()]
    assert got == [[], [], ["a"], ["a", "b", "a b"], ["a", "", "c", "a ", " c", "a  c"]]
