"""Vectors of dictionaries against a plain version."""

import pytest
from pyspark.sql import functions as F

from lakemill.functions.urls import MODEL_FEATURES, with_url
from lakemill.operators import models, vectorizer

ROWS = [
    {"a": 1, "b": "x", "c": True},
    {"a": 2.5, "b": "it's \\ odd", "z": None},
    {"c": False, "a": "three", "é": 7},
    {},
    {"b": "x", "a": -1},
    None,
]


def plain(rows):
    pairs = [{k if not isinstance(v, str) else f"{k}={v}": 1.0 if isinstance(v, str) else float(v) for k, v in (r or {}).items() if v is not None} for r in rows]
    names = sorted({k for p in pairs for k in p})
    return names, [[p.get(n, 0.0) for n in names] for p in pairs]


@pytest.fixture
def frame(spark):
    import json

    rows = [(i, None if r is None else json.dumps(r)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "i int, j string").select("i", F.parse_json("j").alias("d"))


def dense(df):
    return [r["features"].toArray().tolist() for r in df.orderBy("i").collect()]


def test_variant_objects(frame):
    rows = vectorizer.dictionary_terms(frame, "d")
    model, names = vectorizer.fit(rows)
    assert (names, dense(model.transform(rows))) == plain(ROWS)


def test_unseen_names_are_left_out_and_a_saved_model_is_the_same(spark, frame, tmp_path):
    from pyspark.ml import PipelineModel

    rows = vectorizer.dictionary_terms(frame, "d")
    model, names = vectorizer.fit(rows.where("i < 2"))
    assert names == plain(ROWS[:2])[0]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    want = [[{k if not isinstance(v, str) else f"{k}={v}": v for k, v in (r or {}).items()}.get(n, 0) for n in names] for r in ROWS]
    want = [[1.0 if isinstance(v, str) else float(v or 0) for v in r] for r in want]
    assert dense(model.transform(rows)) == dense(again.transform(rows)) == want


def test_maps_structs_and_limits(spark):
    rows = [{"k": "1", "s": "a"}, {"k": "2"}, {}]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, d map<string,string>")
    made = vectorizer.dictionary_terms(df, "d")
    model, names = vectorizer.fit(made)
    assert (names, dense(model.transform(made))) == plain(rows)
    with pytest.raises(ValueError):
        vectorizer.fit(made, most=2)
    with pytest.raises(ValueError):
        vectorizer.fit(made.where("i = 2"))
    with pytest.raises(TypeError):
        vectorizer.entries(df, "i")
    with pytest.raises(TypeError):
        vectorizer.entries(df.withColumn("d", F.array("i")), "d")


def test_url_forest_learns_from_the_selected_features(spark):
    df = with_url(spark.createDataFrame([(i, f"http://h{i}-x.example.com/a{'b' * i}?q={i}") for i in range(20)], "i int, url string"), "url")
    made = models.url_feature_terms(df)
    model, names = vectorizer.fit(made)
    assert names == sorted(MODEL_FEATURES)
    rows = made.withColumns({"label": F.col("i") % 2, "sample_id": F.col("i")})
    featurizer = models.Featurizer("dictionary")
    old = models.ESTIMATORS["url_forest"]
    models.ESTIMATORS["url_forest"] = lambda n: old(n).setNumTrees(5)
    try:
        bundle = models.train(rows, featurizer, "url_forest")
    finally:
        models.ESTIMATORS["url_forest"] = old
    assert featurizer.names == names and bundle.predict(rows.withColumn("label", F.col("label").cast("double"))).count() == 20
    assert models.predict_one(bundle, spark, {"url": "http://a-b.example.com/"}, models.url_feature_terms)["predicted"] in (0, 1)
