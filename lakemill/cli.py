"""Command line: ``python -m lakemill.cli COMMAND ...``; results are JSON on standard output."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def commands(spark: SparkSession) -> dict:
    from lakemill.functions.text import VIEWS
    from lakemill.operators import adaptive, balance, fusion, metrics, splits
    from lakemill.plans import build
    from lakemill.sources import adapters, export, readers, sinks

    rows = lambda df, n=20: [r.asDict(recursive=True) for r in df.limit(n).collect()]
    scores = lambda p: spark.read.parquet(p).withColumn("score", F.col("score_prob"))
    processed = lambda p: sinks.read_view(spark, p).select("sample_id", "language", "normalized_text", F.col("url_features.registered_domain").alias("registered_domain"), F.coalesce(F.col("html_features.action_texts"), F.array().cast("array<string>")).alias("action_texts"), "seq")
    any_rows = lambda p: readers.read_any(spark, p) if readers.suffix_of(p) in readers.READERS else sinks.read_view(spark, p)
    return {
        "list-datasets": lambda a: {"adapters": adapters.names(), "views": list(VIEWS)},
        "inspect-adapter": lambda a: [adapters.readiness(spark, k, p) | {"columns": adapters.adapter(k)(spark, p).columns, "snapshot_bytes": export.size_of(spark, p)} for k, p in _pairs(a.source).items()],
        "inspect-source": lambda a: [{"dataset": k, "path": p, "snapshot_bytes": export.size_of(spark, p)} for k, p in _pairs(a.source).items()],
        "estimate-storage": lambda a: export.storage_estimate(spark, _pairs(a.source), a.root, list(VIEWS)),
        "show-config": lambda a: {"views": list(VIEWS), "models": {k: {"view": v[0], "text": v[1], "features": v[3], "estimator": v[4]} for k, v in build.TRACKS.items()}, "english_share": balance.ENGLISH_SHARE, "least_english": balance.LEAST_ENGLISH, "splits": {"test": splits.TEST, "validation": splits.VALIDATION, "seed": splits.SEED}, "most_thresholds": metrics.MOST_THRESHOLDS},
        "compare-runs": lambda a: build.compare(spark, a.out),
        "predict": lambda a: build.predict(spark, f"{a.out}/{a.model}", json.loads(a.sample)),
        "error-analysis": lambda a: rows(adaptive.errors(scores(a.predictions), processed(a.other)), a.limit),
        "generate-heuristic-proposals": lambda a: rows(adaptive.proposals(sinks.read_view(spark, a.other), a.limit), a.limit),
        "export-integration-configs": lambda a: export.export_integration(spark, f"{a.out}/integration", *(lambda r: (r["recommended"], {k: {t: c[t] for t in ("low_threshold", "high_threshold", "binary_threshold")} for k, c in r["calibration"].items()}, r["calibration"]))(sinks.read_document(spark, f"{a.out}/report"))),
        "list-models": lambda a: {"models": list(build.TRACKS)},
        "validate-raw-dataset": lambda a: [adapters.readiness(spark, k, p) for k, p in _pairs(a.source).items()],
        "preview-records": lambda a: {k: rows(adapters.adapter(k)(spark, p), a.limit) for k, p in _pairs(a.source).items()},
        "preview-processed": lambda a: rows(build.preview(spark, _pairs(a.source), a.limit)),
        "build-dataset": lambda a: build.build(spark, _pairs(a.source), a.root, caps={k: a.max_records for k in _pairs(a.source)} if a.max_records else None),
        "show-manifest": lambda a: sinks.read_document(spark, f"{a.root}/reports/summary"),
        "show-dedupe-report": lambda a: sinks.read_document(spark, f"{a.root}/reports/summary")["dedupe"],
        "train-model": lambda a: build.train_track(spark, a.root, a.model, a.out),
        "train-all-baselines": lambda a: [build.train_track(spark, a.root, m, a.out) for m in build.TRACKS],
        "show-training-run": lambda a: sinks.read_document(spark, f"{a.out}/{a.model}/run_summary.json"),
        "evaluate-all": lambda a: build.evaluate_all(spark, a.root, a.out),
        "show-comparison-report": lambda a: sinks.read_document(spark, f"{a.out}/report")["comparison"],
        "show-recommendation": lambda a: sinks.read_document(spark, f"{a.out}/report")["recommended"],
        "calibrate-thresholds": lambda a: metrics.calibrate(scores(a.predictions), a.objective),
        "run-fusion-experiment": lambda a: rows(fusion.fusion_metrics(fusion.weighted(fusion.align(scores(a.predictions), scores(a.other))))),
        "show-drift-report": lambda a: adaptive.drift_document(adaptive.drift_report(any_rows(a.predictions), any_rows(a.other))),
        "export-retraining-candidates": lambda a: rows(adaptive.retraining_candidates(scores(a.predictions), sinks.read_feedback(spark, a.other).withColumn("seq", F.monotonically_increasing_id())), a.limit),
    }


def main(argv: list[str] | None = None) -> int:
    names = list(commands(None)) if argv == ["--help"] else None
    parser = argparse.ArgumentParser(prog="lakemill", epilog=", ".join(names or ()))
    parser.add_argument("command")
    parser.add_argument("--source", action="append", default=[], help="adapter=path, repeatable")
    for flag in ("root", "out", "model", "predictions", "other"):
        parser.add_argument(f"--{flag}")
    parser.add_argument("--sample", default="{}", help="a sample's columns as JSON")
    parser.add_argument("--objective", default="maximize_f1")
    parser.add_argument("--limit", type=int, default=5)
    parser.add_argument("--max-records", type=int)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    known = commands(spark)
    if args.command not in known:
        parser.error(f"unknown command; there are {', '.join(known)}")
    try:
        result = known[args.command](args)
    except Exception as e:  # noqa: BLE001  the command line reports errors as JSON
        print(json.dumps({"error": f"{type(e).__name__}: {e}"[:500]}))
        return 1
    print(json.dumps(result, default=str, indent=2))
    bad = isinstance(result, dict) and result.get("errors") or isinstance(result, list) and any(isinstance(r, dict) and r.get("status") == "not_ready" for r in result)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
