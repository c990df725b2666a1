"""Files for the service that uses the models, storage estimates, and discovery of training runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemill.sources.sinks import read_document, write_document

#: A prediction as the service returns it; fixed values.
PREDICTION_EXAMPLE = {
    "request_id": "req_example_001",
    "model_name": "xlmr_sequence_classifier",
    "model_version": "2026.04.22",
    "track": "webpage_transformer",
    "score": 0.91,
    "predicted_label": 1,
    "risk_level": "high",
    "thresholds_used": {"low_threshold": 0.22, "high_threshold": 0.76, "binary_threshold": 0.76},
    "top_contributing_signals": ["server_model_score_high", "password_input_present", "phishing_cta_pattern"],
    "source_metadata_summary": {"language": "en", "registered_domain": "example-login.com"},
    "language": "en",
    "explanation_stub": "High-risk server-side phishing classification. Reason codes are placeholders for future evidence fusion.",
    "reason_codes": ["server_model_high_score", "html_password_input", "cta_verify_account"],
}
#: Signals that may join the scores later; fixed values.
FUSION_PLACEHOLDERS = ["heuristic_score", "permission_abuse_signals", "structural_webpage_indicators", "reason_codes"]


def yaml_lines(value, indent: int = 0) -> list[str]:
    """Block YAML of nested dicts, lists and scalars, keys in order; strings are quoted as in JSON."""
    import json

    pad = "  " * indent
    if isinstance(value, dict) and value:
        return [line for k, v in value.items() for line in ([f"{pad}{k}:", *yaml_lines(v, indent + 1)] if isinstance(v, (dict, list)) and v else [f"{pad}{k}: {json.dumps(v)}"])]
    if isinstance(value, list) and value:
        return [line for v in value for line in ([f"{pad}-", *yaml_lines(v, indent + 1)] if isinstance(v, (dict, list)) and v else [f"{pad}- {json.dumps(v)}"])]
    return [f"{pad}{json.dumps(value)}"]


def write_yaml(spark: SparkSession, doc, path: str) -> None:
    """A YAML document as one file in a folder."""
    spark.createDataFrame([("\n".join(yaml_lines(doc)),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def export_integration(spark: SparkSession, out: str, recommendations, thresholds: dict, risk_mappings: dict) -> dict[str, str]:
    """Write the six files and return where they are."""
    files = {
        "model_recommendations": ("model_recommendations.json", recommendations),
        "threshold_configs": ("threshold_configs.json", thresholds),
        "risk_mapping_configs": ("risk_mapping_configs.json", risk_mappings),
        "prediction_schema_json": ("prediction_schema.example.json", PREDICTION_EXAMPLE),
        "prediction_schema_yaml": ("prediction_schema.schema.yaml", {"server_side_only": True, "schema_fields": PREDICTION_EXAMPLE, "future_fusion_placeholders": FUSION_PLACEHOLDERS}),
        "score_interpretation": (
            "score_interpretation.json",
            {
                "note": "Scores map to low, medium and high risk on the server through each model's own thresholds.",
                "future_fusion_note": "The final risk may later combine heuristics, permissions and structural indicators.",
            },
        ),
    }
    for name, doc in files.values():
        (write_yaml if name.endswith(".yaml") else write_document)(spark, doc, f"{out}/{name}")
    return {key: f"{out}/{name}" for key, (name, _) in files.items()}


#: Bytes a view takes for each byte of its snapshots; fixed values. Pages take the second with their HTML kept.
VIEW_FACTORS = {"unified_url_dataset": 0.08, "unified_webpage_dataset": (0.28, 1.0), "unified_tabular_dataset": 0.05, "unified_auxiliary_text_dataset": 0.08}
SPARE_BYTES, SPARE_FACTOR = 128 << 20, 1.25


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a path in any store; nothing there is zero."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def free_bytes(spark: SparkSession, path: str) -> int:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getStatus(None).getRemaining()


def storage_estimate(spark: SparkSession, snapshots: dict[str, str], root: str, views: list[str], keep_html: bool = False) -> dict:
    """What a build will need and whether the store has it."""
    raw = sum(size_of(spark, p) for p in snapshots.values())
    factors = (VIEW_FACTORS.get(v, 0.0) for v in views)
    needed = int(raw * sum(f[keep_html] if isinstance(f, tuple) else f for f in factors)) + SPARE_BYTES
    least, free = int(needed * SPARE_FACTOR), free_bytes(spark, root)
    return {"raw_snapshot_bytes": raw, "estimated_required_bytes": needed, "recommended_minimum_bytes": least, "free_bytes": free, "likely_insufficient": free < least, "selected_views": list(views), "snapshot_roots": dict(snapshots)}


def discover_runs(spark: SparkSession, root: str, name: str = "run_summary.json", depth: int = 4) -> list[str]:
    """Sorted paths of all run summaries under ``root``, each a file or a folder of one document."""
    found, conf = [], spark._jsc.hadoopConfiguration()
    for k in range(depth):
        pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{'*/' * k}{name}")
        found += [s.getPath().toString() for s in pattern.getFileSystem(conf).globStatus(pattern) or []]
    return sorted(found)


def read_runs(spark: SparkSession, root: str) -> list[dict]:
    """The summaries of all runs, each with the folder it lies in."""
    return [read_document(spark, p) | {"run_dir": p.rsplit("/", 1)[0]} for p in discover_runs(spark, root)]


def comparison_rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    """(run, track, test metrics) of run summaries."""
    fields = ("accuracy", "precision", "recall", "f1", "false_positive_rate", "roc_auc", "pr_auc")
    flat = [(r["model_name"], r["track"], *[(r.get("metrics", {}).get("test") or {}).get(f) for f in fields]) for r in runs]
    return spark.createDataFrame(flat, "run string, track string, " + ", ".join(f"{f} double" for f in fields))
