"""From source snapshots to views, and from trained models to recommendations."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.scalars import hash_fraction
from lakemill.functions.text import VIEWS, canonical_language, supervised_only
from lakemill.operators import adaptive, balance, dedup, fusion, metrics, models, splits, stats
from lakemill.operators.storage import cut
from lakemill.plans.canonical import canonicalize
from lakemill.sources import adapters, export, sinks


def preview(spark: SparkSession, snapshots: dict[str, str], n: int = 5, views: list[str] | None = None) -> DataFrame:
    """The first kept rows with a selected view."""
    rows = _ordered(adapters.load_sources(spark, snapshots))
    kept, _, _ = dedup.deduplicate(rows)
    wanted = F.array(*map(F.lit, views or VIEWS))
    return kept.where(F.size(F.array_intersect("views", wanted)) > 0).orderBy("seq").limit(n)


def _ordered(raw: DataFrame) -> DataFrame:
    """Canonical records with a ``seq`` that orders them by source, file and row.

    Written once, so that the order is the same wherever it is used.
    """
    order = ["source_rank", *adapters.in_order(), "sample_id"]
    rows = canonicalize(raw, carry=("source_rank", "path", "row")).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(rows.withColumn("seq", F.monotonically_increasing_id()).drop("source_rank", "path", "row"), "build")


def build_digest(spark: SparkSession, snapshots: dict[str, str], settings: dict) -> str:
    """A digest of the settings and of the snapshots' files: their names, lengths and times, of which Spark reads no content."""
    found = {}
    for name, path in sorted(snapshots.items()):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        r = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        found[name] = [path, *r]
    return hashlib.sha256(json.dumps([settings, found], sort_keys=True, default=str).encode()).hexdigest()


def _view_states(spark: SparkSession, root: str) -> dict:
    return sinks.read_document(spark, f"{root}/view_states") if sinks.is_complete(spark, f"{root}/view_states") else {}


def build(spark: SparkSession, snapshots: dict[str, str], root: str, views: list[str] | None = None, prefilter: float | None = 0.32, dedupe: bool = True, rebalance: bool = True, fmt: str = "parquet", caps: dict[str, int] | None = None, resume: bool = True) -> dict:
    """Write the views and their reports under ``root``.

    A view that an earlier run finished from the same files with the same settings is kept; one of other settings or files is
    written anew, and so is every view without ``resume``. A run that breaks off leaves the views that it finished.
    """
    views = list(dict.fromkeys(views or VIEWS))
    if unknown := set(views) - set(VIEWS):
        raise ValueError(f"unknown views {sorted(unknown)}")
    digest = build_digest(spark, snapshots, {"prefilter": prefilter, "dedupe": dedupe, "rebalance": rebalance, "fmt": fmt, "caps": caps})
    states = _view_states(spark, root) if resume else {}
    finished = lambda v: states.get(v, {}).get("digest") == digest and sinks.is_complete(spark, f"{root}/{v}" + ("_jsonl" if fmt == "jsonl" else ""))
    done = [v for v in views if finished(v)]
    if len(done) == len(views) and sinks.is_complete(spark, f"{root}/reports/summary"):
        report = sinks.read_document(spark, f"{root}/reports/summary")
        sinks.write_document(spark, {"state": "completed", "views": views, "digest": digest}, f"{root}/state")
        return report | {"state": "completed", "views": {v: states[v]["records"] for v in views}, "resumed": True, "skipped_completed_views": done}
    sinks.write_document(spark, {"state": "running", "views": views, "digest": digest}, f"{root}/state")
    raw = adapters.load_sources(spark, snapshots, caps)
    if prefilter is not None:
        # before any page is parsed
        drop = (F.col("source") == "phreshphish") & (canonical_language("language") == "en") & (hash_fraction(F.col("original_id"), "english_prefilter:") > prefilter)
        raw = raw.where(~F.coalesce(drop, F.lit(False)))
    canonical = _ordered(raw)
    kept, events, removed = dedup.deduplicate(canonical, dedupe)
    kept = cut(kept, "build-kept")
    n = kept.count()
    if not n:
        sinks.write_document(spark, {"state": "failed", "reason": "no records kept"}, f"{root}/state")
        raise RuntimeError("no records kept")
    chosen = kept.where(F.size(F.array_intersect("views", F.array(*map(F.lit, views)))) > 0)
    counts = {v: states[v]["records"] for v in done}
    for view in views:
        if view in done:
            continue
        rows = chosen.where(F.array_contains("views", view))
        if rebalance and view in VIEWS[:2]:
            rows = balance.rebalance(rows)
        counts |= sinks.write_views(rows, root, [view], fmt, overwrite=True)
        states = states | {view: {"digest": digest, "records": counts[view]}}
        sinks.write_document(spark, states, f"{root}/view_states")
    sinks.write_jsonl(events.orderBy("seq").limit(200), f"{root}/reports/duplicates_sample")
    exclusions = [r.asDict() for r in stats.exclusions(canonical, kept).orderBy("source_dataset", "reason").collect()]
    sinks.write_document(spark, exclusions, f"{root}/reports/exclusions")
    report = {
        "state": "completed",
        "digest": digest,
        "resumed": bool(done),
        "skipped_completed_views": done,
        "views": counts,
        "kept_records": n,
        "sources": [r.asDict() for r in stats.source_summary(canonical, kept).orderBy("source_dataset").collect()],
        "dedupe": [r.asDict() for r in removed.orderBy("scope", "matched_on").collect()],
        "kept_and_removed": {"kept": n, "removed": events.count()},
        "exclusions": exclusions,
        "storage": export.storage_estimate(spark, snapshots, root, views),
        "view_stats": [r.asDict() for r in stats.view_stats(kept).orderBy("view", "source_dataset").collect()],
    }
    sinks.write_document(spark, report, f"{root}/reports/summary")
    sinks.write_document(spark, {"state": "completed", "views": views, "digest": digest}, f"{root}/state")
    return report


#: Tracks: which view, which text, which features, which estimator.
TRACKS = {
    "url_tfidf_logreg": ("unified_url_dataset", "normalized_url", models.url_terms, "tfidf", "logistic_regression"),
    "url_tfidf_svm": ("unified_url_dataset", "normalized_url", models.url_terms, "tfidf", "linear_svm"),
    "text_tfidf_logreg": ("unified_webpage_dataset", "normalized_text", models.text_terms, "tfidf", "logistic_regression"),
    "text_tfidf_svm": ("unified_webpage_dataset", "normalized_text", models.text_terms, "tfidf", "linear_svm"),
    "url_random_forest": ("unified_url_dataset", "url_features", models.url_feature_terms, "dictionary", "url_forest"),
    "tabular_random_forest": ("unified_tabular_dataset", "tabular_features", models.tabular_terms, "dictionary", "random_forest"),
    "tabular_gradient_boosting": ("unified_tabular_dataset", "tabular_features", models.tabular_terms, "dictionary", "gradient_boosting"),
}


def train_track(spark: SparkSession, root: str, name: str, out: str, strategy: str = "stratified") -> dict:
    """Train one track on its view, save predictions of the test rows, metrics and the split."""
    view, text, terms, kind, estimator = TRACKS[name]
    filled = F.size(text) > 0 if text == "tabular_features" else F.col(text).isNotNull()
    rows, left_out = supervised_only(sinks.read_view(spark, f"{root}/{view}"), "normalized_label", F.coalesce(filled, F.lit(False)))
    rows = rows.withColumn("label", F.col("normalized_label"))
    group = splits.domain_group(F.col("url_features.registered_domain"), F.col("url_features.hostname"), F.col("source_dataset"))
    rows, split_report = splits.split_with_report(rows, strategy, "sample_id", "label", group=group, ts_text=F.col("timestamp"))
    rows = cut(rows, "train")
    bundle = models.train(terms(rows.where("split = 'train'"), text), models.Featurizer(kind), estimator)
    scored = terms(rows, text).withColumn("label", F.col("label").cast("double"))
    sinks.write_parquet(bundle.predict(scored), f"{out}/{name}/predictions")
    sinks.write_split(rows, f"{out}/{name}/split")
    by_split = {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"} for r in models.evaluate(bundle, scored).collect()}
    summary = {"model_name": name, "track": view, "run_dir": f"{out}/{name}", "metrics": by_split, "excluded_counts": left_out.first().asDict()}
    bundle.save(f"{out}/{name}/model")
    sinks.write_document(spark, {"labels": {"0": "benign", "1": "phishing"}, "text": text, "features": kind, "feature_names_used": bundle.featurizer.names or [text], "estimator": estimator}, f"{out}/{name}/label_metadata")
    sinks.write_document(spark, {"pyspark": spark.version, "strategy": strategy, "seed": splits.SEED}, f"{out}/{name}/versions")
    sinks.write_document(spark, split_report, f"{out}/{name}/split_manifest")
    sinks.write_document(spark, summary, f"{out}/{name}/run_summary.json")
    return summary


def predict(spark: SparkSession, run_dir: str, sample: dict) -> dict:
    """Score one sample with a saved run."""
    summary = sinks.read_document(spark, f"{run_dir}/run_summary.json")
    _, _, terms, kind, _ = TRACKS[summary["model_name"]]
    return models.predict_one(models.Bundle.load(f"{run_dir}/model", kind), spark, sample, terms) | {"model_name": summary["model_name"], "track": summary["track"]}


def compare(spark: SparkSession, root: str) -> list[dict]:
    """All runs under a folder, ranked by track."""
    runs = export.read_runs(spark, root)
    return [r.asDict() for r in fusion.rank_runs(export.comparison_rows(spark, runs)).orderBy("track", "rank").collect()] if runs else []


def evaluate_all(spark: SparkSession, root: str, out: str, names: list[str] | None = None, weights: dict[str, float] | None = None) -> dict:
    """Train what is missing, compare, recommend, calibrate the best of each track and analyse its errors."""
    runs, failed = [], {}
    for name in names or list(TRACKS):
        try:
            done = sinks.is_complete(spark, f"{out}/{name}/run_summary.json")
            runs.append(sinks.read_document(spark, f"{out}/{name}/run_summary.json") if done else train_track(spark, root, name, out))
        except Exception as e:  # noqa: BLE001  a failing track must not stop the others; it is reported
            failed[name] = f"{type(e).__name__}: {e}"[:300]
    if not runs:
        return {"comparison": None, "errors": failed}
    table = export.comparison_rows(spark, runs)
    ranked = fusion.rank_runs(table)
    sinks.write_comparison(ranked, f"{out}/comparison")
    documents = spark.createDataFrame([(r["run_dir"], json.dumps(r, default=str)) for r in runs], "run_dir string, document string")
    sinks.write_comparison(fusion.run_rows(documents), f"{out}/runs")
    best = fusion.recommend(table, weights or {"f1": 0.4, "pr_auc": 0.4, "false_positive_rate": -0.2}).collect()
    result = {"comparison": [r.asDict() for r in ranked.orderBy("track", "rank").collect()], "recommended": [r.asDict() for r in best], "calibration": {}, "errors": failed}
    for r in best:
        if r["rank"] == 1:
            test = spark.read.parquet(f"{out}/{r['run']}/predictions").where("split = 'test'").withColumn("score", F.col("score_prob"))
            result["calibration"][r["run"]] = metrics.calibrate(test)
            processed = spark.read.parquet(f"{root}/{r['track']}").select("sample_id", "language", "normalized_text", F.col("url_features.registered_domain").alias("registered_domain"), F.coalesce(F.col("html_features.action_texts"), F.array().cast("array<string>")).alias("action_texts"), "seq")
            wrong = adaptive.errors(test, processed)
            sinks.write_jsonl(wrong, f"{out}/{r['run']}/errors")
            sinks.write_jsonl(adaptive.opportunities(wrong), f"{out}/{r['run']}/opportunities")
    sinks.write_document(spark, result, f"{out}/report")
    cells = list(result["comparison"][0])
    sinks.write_text(spark, "# Comparison\n\n" + sinks.markdown_table(result["comparison"], cells) + "\n\n# Recommendation\n\n" + sinks.markdown_table(result["recommended"], list(result["recommended"][0]) if result["recommended"] else cells), f"{out}/report.md")
    bounds = {k: {t: c[t] for t in ("low_threshold", "high_threshold", "binary_threshold")} for k, c in result["calibration"].items()}
    result["integration"] = export.export_integration(spark, f"{out}/integration", result["recommended"], bounds, result["calibration"])
    return result
