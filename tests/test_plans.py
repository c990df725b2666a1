"""Building views, training, evaluation, streaming and the command line on small snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from lakemill import cli
from lakemill.functions import html, urls
from lakemill.operators import adaptive, models, splits
from lakemill.plans import build, catalogue, learning
from lakemill.sources import export, sinks
from lakemill.streaming import scorer


@pytest.fixture(scope="module")
def snapshots(tmp_path_factory):
    d = tmp_path_factory.mktemp("snapshots")
    with open(d / "pages.jsonl", "w") as f:
        for i in range(120):
            bad = i % 2
            word = "verify your account login" if bad else "welcome to our garden club"
            page = f"<html lang='en'><title>t{i}</title><body>{word} number {i % 40}</body></html>"
            f.write(json.dumps({"id": str(i), "url": f"http://{'secure-login' if bad else 'garden'}{i}.example{i % 9}.com/a/{i}", "html": page, "label": "phish" if bad else "benign", "lang": "fr" if i % 3 else "en"}) + "\n")
    (d / "feed.txt").write_text("http://bad.example.com/login\nhttp://bad.example.com/login\n# c\n")
    return {"phreshphish": str(d / "pages.jsonl"), "openphish": str(d / "feed.txt")}


def test_build_train_evaluate(spark, snapshots, tmp_path):
    root, out = str(tmp_path / "data"), str(tmp_path / "runs")
    report = build.build(spark, snapshots, root, rebalance=False, prefilter=None)
    seen = {r["source_dataset"]: r for r in report["sources"]}
    assert seen["openphish"]["records"] == 2 and seen["openphish"]["kept"] == 1
    assert report["views"]["unified_url_dataset"] == report["kept_records"] > 40
    assert {r["matched_on"] for r in report["dedupe"]} >= {"original_url", "normalized_url"}
    summary = build.train_track(spark, root, "url_tfidf_logreg", out)
    assert summary["metrics"]["test"]["f1"] > 0.9
    result = build.evaluate_all(spark, root, out, ["url_tfidf_logreg", "text_tfidf_svm", "missing"])
    assert {r["run"] for r in result["comparison"]} == {"url_tfidf_logreg", "text_tfidf_svm"} and "missing" in result["errors"]
    assert result["calibration"] and all(0 <= c["low_threshold"] <= c["binary_threshold"] <= 1 for c in result["calibration"].values())
    assert build.preview(spark, snapshots, 3).count() == 3
    rows = {r["model_name"]: r for r in spark.read.csv(f"{out}/runs", header=True, escape='"').collect()}
    assert set(rows) == {"url_tfidf_logreg", "text_tfidf_svm"} and len(rows["url_tfidf_logreg"]) > 20 and float(rows["url_tfidf_logreg"]["f1"]) == summary["metrics"]["test"]["f1"]
    # runs are found again, saved models give what they gave, and the service gets its files
    found = export.read_runs(spark, out)
    assert [r["model_name"] for r in found] == ["text_tfidf_svm", "url_tfidf_logreg"] and all(r["run_dir"].startswith("file:") for r in found)
    assert {r["run"] for r in build.compare(spark, out)} == {"url_tfidf_logreg", "text_tfidf_svm"} and build.compare(spark, str(tmp_path)) != []
    first = spark.read.parquet(f"{root}/unified_url_dataset").join(spark.read.parquet(f"{out}/url_tfidf_logreg/predictions"), "sample_id").first()
    got = build.predict(spark, f"{out}/url_tfidf_logreg", {"normalized_url": first["normalized_url"]})
    assert got["predicted"] == first["predicted"] and abs(got["score"] - first["score_prob"]) < 1e-5
    files = result["integration"]
    assert len(files) == 6 and sinks.read_document(spark, files["prediction_schema_json"])["risk_level"] == "high"
    assert "server_side_only: true" in spark.read.text(files["prediction_schema_yaml"], wholetext=True).first()[0]
    assert report["storage"]["raw_snapshot_bytes"] > 1000 and report["storage"]["estimated_required_bytes"] > 128 << 20
    assert sum(r["n"] for r in report["exclusions"] if r["reason"] == "duplicate") == report["kept_and_removed"]["removed"]
    assert all(r["candidate_signatures"] for r in spark.read.json(f"{root}/reports/duplicates_sample").collect())
    with pytest.raises(FileNotFoundError):
        sinks.read_view(spark, f"{root}/none")
    with pytest.raises(ValueError):
        build.build(spark, snapshots, root, ["nope"])


def test_learning_queries(spark, sf):
    got = {n: q(spark, sf).cache() for n, q in learning.QUERIES.items()}
    for name in ("ml_tabular_forest", "ml_tabular_boosting", "ml_text_tfidf_svm"):
        mean = {r[0]: r[1] for r in got[name].where("split = 'test'").groupBy("label").agg(F.avg("score_prob")).collect()}
        assert mean[1] > mean[0], name
    assert got["ml_text_tfidf_svm"].where("score_prob between 0 and 1").count() == got["ml_text_tfidf_svm"].count()
    assert got["ml_embedding_logreg"].count() == 500


def test_model_sizes(spark, sf, monkeypatch):
    monkeypatch.setattr(learning, "_fit", lambda df, featurizer, estimator, **settings: (estimator, settings))
    assert all(q(spark, sf)[1] == {} for q in learning.QUERIES.values())
    sizes = {"logistic_regression": {"maxIter": 3000}, "linear_svm": {"maxIter": 1000}, "random_forest": {"numTrees": 400, "maxDepth": 30}, "gradient_boosting": {"maxIter": 300, "maxDepth": 6}}
    for name, want in sizes.items():
        made = models.ESTIMATORS[name](100)
        assert {k: made.getOrDefault(k) for k in want} == want, name


def test_whole_queries_hold_every_row(spark, sf):
    docs = catalogue.table(spark, sf, "documents").count()
    sums = catalogue.QUERIES["drift_distributions"](spark, sf).groupBy("dim").agg(F.sum(F.col("reference") + F.col("current"))).collect()
    assert [r[1] for r in sums] == [docs, docs]
    assert catalogue.QUERIES["fusion_scores"](spark, sf).count() == catalogue.predictions(spark, sf).count()


def test_validation_reports_blank_documents(spark, monkeypatch):
    tables = {
        "pages": spark.createDataFrame([], "page_id long, url string, html string"),
        "documents": spark.createDataFrame([(1, None, "en", "s"), (2, " ", "en", "s"), (3, "words", "en", "s")], "doc_id long, text string, lang string, source string"),
        "labels": spark.createDataFrame([], "doc_id long, toxic int"),
        "conversations": spark.createDataFrame([("c", 1, "hi")], "conv_id string, turn int, text string"),
        "part": spark.createDataFrame([], "p_partkey long, p_size int, p_brand string"),
    }
    monkeypatch.setattr(catalogue, "table", lambda spark, d, name: tables[name])
    got = {tuple(r) for r in catalogue.QUERIES["record_validation"](spark, "").collect()}
    assert got == {("s", "record_has_no_modalities", 2), ("s", "ok", 1), ("oscar_aux", "ok", 1)}


def test_proposals_of_all_generators(spark):
    flags = [*adaptive.URL_FLAGS, *adaptive.HTML_FLAGS]
    rows = spark.range(3).select(F.col("id").alias("seq"), F.lit(1).alias("label"), F.lit("fr").alias("language"), F.lit("compte").alias("normalized_text"), F.array(F.lit("Go on")).alias("action_texts"), F.struct(*[F.lit(True).alias(n) for n in adaptive.URL_FLAGS]).alias("url_features"), F.struct(*[F.lit(True).alias(n) for n in adaptive.HTML_FLAGS]).alias("html_features"))
    got = [r["pattern"] for r in adaptive.proposals(rows).collect()]
    assert sorted(got) == sorted([*flags, "compte", "go on"])
    assert adaptive.proposals(rows, 2).count() == 2


def test_grams(spark):
    row = spark.createDataFrame([("Ab cde",)], "s string").select(models.word_border_grams(F.col("s")).alias("c"), models.word_grams(models.words(F.lit("one two x three"))).alias("w")).first()
    assert sorted(row["c"]) == sorted([" ab", "ab ", " cd", "cde", "de ", " ab ", " cde", "cde ", " ab ", " cde "])
    assert row["w"] == ["one", "two", "three", "one two", "two three"]


def test_splits(spark):
    df = spark.range(100).select(F.col("id").alias("sample_id"), (F.col("id") % 2).alias("label"), (F.col("id") % 10).alias("g"))
    counts = lambda d: {r[0]: r[1] for r in d.groupBy("split").count().collect()}
    assert counts(splits.stratified(df, "sample_id", "label")) == {"train": 70, "validation": 10, "test": 20}
    grouped = splits.by_group(df, F.col("g"))
    assert grouped.select("g", "split").distinct().count() == 10 and counts(grouped) == {"train": 70, "validation": 10, "test": 20}
    assert counts(splits.by_group(df, F.lit(1))) == {"train": 100}
    assert counts(splits.repair_empty(df.withColumn("split", F.lit("train")), "sample_id")) == {"train": 98, "validation": 1, "test": 1}
    timed = splits.time_aware(df, "sample_id", F.when(F.col("sample_id") > 4, F.lpad(F.col("sample_id").cast("string"), 3, "0")))
    assert counts(timed) == {"train": 70, "validation": 10, "test": 20}
    assert {r[0] for r in timed.where("split = 'test'").select("sample_id").collect()} == {0, 1, 2, 3, 4, *range(85, 100)}
    with pytest.raises(ValueError):
        splits.split(df.limit(0), "stratified", "sample_id", "label")


def test_dom_text_and_public_suffixes(spark):
    page = "<html><head><title>x</title></head><body>a<script>b</script> &amp; <p>c</p><style>d</style></body></html>"
    assert spark.createDataFrame([(page,)], "h string").select(html.dom_visible_text("h")).first()[0] == "a & c"
    hosts = spark.createDataFrame([("a.b.co.uk",), ("x.com",), (None,)], "h string")
    got = urls.with_public_suffix(hosts, "h", spark.createDataFrame([("uk",), ("co.uk",), ("com",)], "suffix string"))
    assert {(r["h"], r["public_suffix"]) for r in got.collect()} == {("a.b.co.uk", "co.uk"), ("x.com", "com"), (None, None)}


def test_streaming(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", 0.9), (1, "2024-01-01 00:10:00", 0.9), (2, "2024-01-01 05:00:00", 0.2), (3, "2024-01-03 00:00:00", 0.5)]
    spark.createDataFrame(rows, "id int, t string, score double").select("id", F.to_timestamp("t").alias("ts"), "score").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, ts timestamp, score double").parquet(str(tmp_path / "in"))
    levels = scorer.windowed_levels(scorer.score_stream(scorer.dedup_stream(stream, ["id"])), late=None)
    q = levels.writeStream.outputMode("append").format("memory").queryName("levels").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["risk_level"], r["n"]) for r in spark.table("levels").collect()} <= {("high", 1), ("low", 1), ("medium", 1)}
    with pytest.raises(Exception):
        scorer.dedup_stream(stream, ["none"]).schema  # noqa: B018


def test_command_line(spark, snapshots, capsys, tmp_path):
    assert cli.main(["list-datasets"]) == 0 and "openphish" in capsys.readouterr().out
    assert cli.main(["validate-raw-dataset", "--source", f"openphish={snapshots['openphish']}"]) == 0
    assert cli.main(["validate-raw-dataset", "--source", f"openphish={tmp_path}/none.csv"]) == 1
    assert cli.main(["show-config"]) == 0 and "tabular_random_forest" in capsys.readouterr().out
    assert cli.main(["estimate-storage", "--root", str(tmp_path), "--source", f"openphish={snapshots['openphish']}"]) == 0 and "free_bytes" in capsys.readouterr().out
    assert cli.main(["inspect-adapter", "--source", f"openphish={snapshots['openphish']}"]) == 0 and '"ready"' in capsys.readouterr().out
    assert cli.main(["compare-runs", "--out", str(tmp_path)]) == 0
    assert cli.main(["show-manifest", "--root", str(tmp_path)]) == 1 and "error" in capsys.readouterr().out.rsplit("{", 1)[-1]


def test_split_fallbacks(spark):
    df = spark.range(60).select(F.col("id").alias("sample_id"), (F.col("id") % 2).alias("label"), (F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 == 0, " Test ").when(F.col("id") % 5 == 1, "valid").alias("source_split"))
    ask = lambda d, s, **k: splits.split_with_report(d, s, "sample_id", "label", **k)[1]
    one = ask(df, "group", group=F.lit("x"))
    assert one["fallback_reason"] == splits.ONE_GROUP and one["strategy"] == "stratified" and one["counts"] == {"train": 42, "validation": 6, "test": 12}
    assert "fallback_reason" not in ask(df, "group", group=F.col("g"))
    # two groups: test takes one, and the other's rows are split
    two = ask(df, "group", group=F.col("sample_id") < 40)
    assert min(two["counts"].values()) > 0 and two["group_count"] == 2 and two["counts"]["test"] in (20, 40)
    assert ask(df.limit(2), "time_aware", ts_text=F.lit("2024-01-01"))["fallback_reason"] == splits.TOO_FEW_ROWS
    own = ask(df, "predefined")
    assert own["counts"]["test"] == 12 and own["passthrough_count"] == 12 and own["counts"]["validation"] == 1
    assert ask(df.where("sample_id % 5 <> 0"), "predefined")["fallback_reason"] == splits.NO_SOURCE_SPLITS
    odd = ask(df.withColumn("label", F.when(F.col("sample_id") > 3, F.col("label"))), "stratified")
    assert odd["strategy"] == "unstratified" and odd["counts"] == {"train": 42, "validation": 6, "test": 12} and sum(v["null"] for v in odd["label_counts"].values()) == 4
    with pytest.raises(ValueError):
        ask(df, "other")


def test_build_resumes_by_settings_and_files(spark, snapshots, tmp_path):
    root, url, page = str(tmp_path / "data"), "unified_url_dataset", "unified_webpage_dataset"
    written = lambda v: {p.name for p in (tmp_path / "data" / v).glob("part-*")}
    first = build.build(spark, snapshots, root, [url], prefilter=None, rebalance=False)
    files = written(url)
    assert not first["resumed"] and first["views"][url] == first["kept_records"]
    again = build.build(spark, snapshots, root, [url], prefilter=None, rebalance=False)
    assert again["resumed"] and again["skipped_completed_views"] == [url] and again["views"] == first["views"] and written(url) == files
    # another prefilter writes the view anew, a further view is added to it, and the first stays as it is
    fewer = build.build(spark, snapshots, root, [url], prefilter=0.0, rebalance=False)
    assert not fewer["resumed"] and fewer["views"][url] < first["views"][url] and not written(url) & files
    files = written(url)
    both = build.build(spark, snapshots, root, [url, page], prefilter=0.0, rebalance=False)
    assert both["skipped_completed_views"] == [url] and both["views"][url] == fewer["views"][url] and both["views"][page] > 0 and written(url) == files
    (tmp_path / "feed.txt").write_text("http://other.example.com/login\n")
    assert not build.build(spark, snapshots | {"openphish": str(tmp_path / "feed.txt")}, root, [url], prefilter=0.0, rebalance=False)["resumed"]
    assert isinstance(sinks.read_document(spark, f"{root}/reports/exclusions"), list)
    # what the command line does with views
    view = sinks.read_view(spark, f"{root}/{url}")
    assert adaptive.proposals(view, 5).count() > 0
    report = adaptive.drift_document(adaptive.drift_report(view.where("normalized_label = 1"), view.where("normalized_label = 0")))
    assert report["label_distribution"]["js_divergence"] == pytest.approx(1.0) and report["score_distribution"] == {"available": False} and report["top_token_shift"]


def test_run_rows_of_uneven_documents(spark):
    from lakemill.operators import fusion

    good = {"track": "url", "model_name": "m", "metrics": {"test": {"f1": 0.5, "sample_count": 7, "confusion_matrix": {"tn": 3}, "recall": "high"}, "excluded_counts": None}, "excluded_counts": {"null": 2}, "config": {"feature_names_used": ["a", "b"]}}
    other = {"track": "odd", "metrics": {"test": {}, "validation": {"f1": 1}, "class_distribution": {"0": 1}}, "server_side_inference_only": "yes"}
    texts = [json.dumps(good), json.dumps(other), json.dumps({"metrics": {"test": None}}), json.dumps([good]), "no json", "", None, json.dumps({"metrics": {}})]
    rows = fusion.run_rows(spark.createDataFrame([(f"/a/run{k}/", t) for k, t in enumerate(texts)], "run_dir string, document string")).orderBy("run_dir").collect()
    assert [r["run_id"] for r in rows] == ["url:m:run0", "odd::run1"]
    a, b = rows
    assert (a["f1"], a["sample_count"], a["tn"], a["fp"], a["recall"], a["excluded_counts"], a["feature_names_used"]) == (0.5, 7.0, 3, None, None, '{"null":2}', '["a","b"]')
    assert (b["track_group"], b["f1"], b["class_distribution"], b["server_side_inference_only"], b["excluded_counts"]) == ("odd", None, '{"0":1}', True, None)
    assert fusion.run_rows(spark.createDataFrame([("/a", json.dumps(other))], "run_dir string, document string"), "validation").first()["f1"] == 1.0


@pytest.mark.parametrize("name", ["view_stats", "canonical_view_counts"])
def test_python_runs_once_for_each_kind_of_record(spark, sf, name):
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 4  # 8 with a filter by the views below them
