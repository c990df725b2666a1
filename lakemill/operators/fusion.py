"""Fusion of two models' scores, comparison and ranking of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators import metrics


def align(url: DataFrame, web: DataFrame, key: str = "sample_id") -> DataFrame:
    """Inner join of predictions; the label is the URL model's."""
    for side in (url, web):
        if key not in side.columns:
            raise ValueError(f"predictions need {key}")
    right = web.select(key, F.col("score").alias("score_webpage"))
    return url.select(key, "label", F.col("score").alias("score_url")).join(right, key)


def alignment_stats(url: DataFrame, web: DataFrame, key: str = "sample_id") -> DataFrame:
    """Totals, rows joined and rows lost on each side, from per-key counts without the join's rows."""
    sides = url.select(key, F.lit(1).alias("u"), F.lit(0).alias("w")).union(web.select(key, F.lit(0), F.lit(1)))
    per_key = sides.groupBy(key).agg(F.sum("u").alias("u"), F.sum("w").alias("w"))
    met = F.when(F.col(key).isNotNull(), F.col("u") * F.col("w")).otherwise(0)
    return per_key.agg(F.sum("u").alias("total_url"), F.sum("w").alias("total_webpage"), F.sum(met).alias("intersected")).select("*", (F.col("total_url") - F.col("intersected")).alias("dropped_url"), (F.col("total_webpage") - F.col("intersected")).alias("dropped_webpage"))


def weighted(df: DataFrame, url: float = 0.4, web: float = 0.6) -> DataFrame:
    return df.withColumn("score", F.col("score_url") * url + F.col("score_webpage") * web)


def cascade(df: DataFrame, high: float = 0.9, low: float = 0.1) -> DataFrame:
    """The URL score where it is sure, else the page score."""
    u = F.col("score_url")
    return df.withColumns({"score": F.when((u >= high) | (u <= low), u).otherwise(F.col("score_webpage")), "decided_by": F.when((u >= high) | (u <= low), "url").otherwise("webpage")})


def fusion_metrics(df: DataFrame) -> DataFrame:
    scored = df.withColumns({"predicted": (F.col("score") >= 0.5).cast("int"), "one": F.lit(1)})
    return metrics.confusion(scored, ["one"]).join(metrics.curve_areas(scored, ["one"]), "one", "left").drop("one")


# --- runs ----------------------------------------------------------------------------------------


def rank_runs(runs: DataFrame) -> DataFrame:
    """By track, then f1 (none and 0 last), then pr_auc."""
    key = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(-1.0)).desc()
    return runs.withColumn("rank", F.row_number().over(Window.partitionBy("track").orderBy(key("f1"), key("pr_auc"), "run")))


def selection_score(runs: DataFrame, weights: dict[str, float], per: str = "track") -> DataFrame:
    """Weighted mean of min-max scaled metrics; a negative weight turns a metric round, missing ones drop out."""
    w = Window.partitionBy(per)
    total, norm = F.lit(0.0), F.lit(0.0)
    for name, weight in weights.items():
        c = F.col(name)
        low, high = F.min(c).over(w), F.max(c).over(w)
        scaled = F.when(high == low, F.lit(1.0)).otherwise((c - low) / F.nullif(high - low, F.lit(0.0)))
        scaled = F.when(high == low, scaled).otherwise(1 - scaled) if weight < 0 else scaled
        total = total + F.when(c.isNotNull(), scaled * abs(weight)).otherwise(0.0)
        norm = norm + F.when(c.isNotNull(), F.lit(abs(weight))).otherwise(0.0)
    return runs.withColumn("selection_score", metrics.ratio(total, norm))


def recommend(runs: DataFrame, weights: dict[str, float], k: int = 5) -> DataFrame:
    scored = selection_score(runs, weights)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("track").orderBy(F.desc_nulls_last("selection_score"), "run"))).where(F.col("rank") <= k)


def flatten_runs(summaries: DataFrame) -> DataFrame:
    """Comparison rows from run summaries with a nested ``metrics`` struct of a ``test`` struct."""
    test = F.col("metrics.test")
    fields = ("sample_count", "accuracy", "precision", "recall", "f1", "false_positive_rate", "false_negative_rate", "roc_auc", "pr_auc")
    return summaries.select(F.col("run_dir").alias("run"), "track", "model_name", *[test[f].alias(f) for f in fields])


#: Numbers of a split's metrics in a comparison row.
RUN_NUMBERS = ("sample_count", "accuracy", "precision", "recall", "f1", "pr_auc", "roc_auc", "false_positive_rate", "false_negative_rate")
#: Which view a track learns from, and which tracks are compared with each other.
TRACK_GROUPS = {"url": "url", "webpage": "webpage", "webpage_text": "webpage", "webpage_transformer": "webpage", "tabular": "tabular"}


def run_rows(documents: DataFrame, split: str = "test") -> DataFrame:
    """Comparison rows of run summaries of any shape: (run_dir, document), a document being its JSON text.

    Documents are read as VARIANT, so no schema is agreed on: what a run lacks is null, a value that cannot be read as the column's kind is null too,
    and nested values come as JSON. Of places that may hold a value the summary's own comes before its metrics' and its configuration's.
    Runs without metrics of the split, and texts that are no JSON object, have no row.
    """
    v = F.try_parse_json("document")
    rows = documents.withColumn("v", v).withColumn("m", F.try_variant_get("v", f"$.metrics.{split}", "variant"))
    rows = rows.where(F.schema_of_variant("m").startswith("OBJECT"))
    at = lambda path, kind="string": F.try_variant_get("v", path, kind)

    def nested(*paths):
        return F.coalesce(*[F.when(~F.is_variant_null(x), F.to_json(x)) for x in (at(p, "variant") for p in paths)])

    name = F.regexp_extract(F.regexp_replace("run_dir", "/+$", ""), "([^/]*)$", 1)
    groups = F.create_map(*[F.lit(x) for pair in TRACK_GROUPS.items() for x in pair])
    track = at("$.track")
    return rows.select(
        F.concat_ws(":", F.coalesce(track, F.lit("")), F.coalesce(at("$.model_name"), F.lit("")), name).alias("run_id"), name.alias("run_name"), "run_dir", track.alias("track"),
        F.coalesce(groups[track], track).alias("track_group"), at("$.model_name").alias("model_name"), F.coalesce(at("$.config.split.strategy"), at("$.metrics.split_strategy")).alias("split_strategy"),
        F.coalesce(at("$.training_mode"), at("$.config.model_config.training_mode")).alias("training_mode"),
        F.coalesce(at("$.server_side_inference_only", "boolean"), at("$.config.server_side_inference_only", "boolean"), F.lit(False)).alias("server_side_inference_only"),
        F.coalesce(at(f"$.artifact_paths.{split}_predictions"), at("$.artifact_paths.test_predictions")).alias("predictions_path"), at("$.artifact_paths.metrics").alias("metrics_path"), at("$.artifact_paths.split_manifest").alias("split_manifest_path"),
        *[F.try_variant_get("m", f"$.{n}", "double").alias(n) for n in RUN_NUMBERS], *[F.try_variant_get("m", f"$.confusion_matrix.{n}", "long").alias(n) for n in ("tn", "fp", "fn", "tp")],
        nested("$.metrics.class_distribution").alias("class_distribution"), nested("$.excluded_counts", "$.metrics.excluded_counts").alias("excluded_counts"),
        nested("$.metrics.text_field_priority", "$.config.text_field_priority").alias("text_field_priority"), nested("$.config.input_fields").alias("input_fields"),
        nested("$.config.feature_names_used", "$.feature_names_used").alias("feature_names_used"), nested("$.artifact_paths").alias("artifact_paths"), nested("$.package_versions").alias("package_versions"),
    )
