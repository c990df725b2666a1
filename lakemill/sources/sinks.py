"""Writers: views, splits, reports and manifests, all through Spark so that any shared store works."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> None:
    """Compressed by zstd; the committer makes it all or nothing."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_views(df: DataFrame, root: str, views: list[str], fmt: str = "parquet", overwrite: bool = False) -> dict[str, int]:
    """One folder a view; a record goes to all of its views. Views that exist in full are left alone unless ``overwrite``."""
    spark, counts = df.sparkSession, {}
    for view in views:
        path = f"{root.rstrip('/')}/{view}"
        if overwrite or not is_complete(spark, path if fmt != "jsonl" else path + "_jsonl"):
            rows = df.where(F.array_contains("views", view)).drop("views")
            if fmt in ("parquet", "both"):
                write_parquet(rows, path)
            if fmt in ("jsonl", "both"):
                write_jsonl(rows, path + "_jsonl")
        counts[view] = (spark.read.parquet(path) if fmt != "jsonl" else spark.read.json(path + "_jsonl")).count()
    return counts


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer has finished at this path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_document(spark: SparkSession, doc: dict | list, path: str) -> None:
    """A JSON document as one file in a folder."""
    spark.createDataFrame([(json.dumps(doc, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A text as one file in a folder."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_view(spark: SparkSession, path: str) -> DataFrame:
    """A processed view as Parquet, or as JSON lines where there is no Parquet."""
    if is_complete(spark, path):
        return spark.read.parquet(path)
    if is_complete(spark, path + "_jsonl"):
        return spark.read.json(path + "_jsonl")
    raise FileNotFoundError(f"no processed view at {path}; build it first")


def write_feedback(df: DataFrame, path: str) -> None:
    """Feedback records as JSON lines, in the columns of FEEDBACK_SCHEMA."""
    have = set(df.columns)
    names = [f.split(" ")[0] for f in FEEDBACK_SCHEMA.replace("map<string,string>", "map").split(", ")]
    df.select(*[F.col(n) for n in names if n in have]).write.mode("append").json(path)


def read_document(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def write_comparison(df: DataFrame, path: str) -> None:
    """Comparison rows as CSV with nested cells as JSON."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    cols = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).coalesce(1).write.mode("overwrite").csv(path, header=True)


def markdown_table(rows: list[dict], columns: list[str]) -> str:
    """Floats with four decimals, nulls empty."""
    cell = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(columns) + " |", "| " + " | ".join("---" for _ in columns) + " |"]
    return "\n".join(lines + ["| " + " | ".join(cell(r.get(c)) for c in columns) + " |" for r in rows])


def write_split(df: DataFrame, path: str) -> None:
    """Assignments and the counts of each split."""
    df.select("sample_id", "split", "source_dataset", "normalized_label").write.mode("overwrite").json(f"{path}/assignments")
    counts = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    write_document(df.sparkSession, {"counts": counts, "total": sum(counts.values())}, f"{path}/manifest")


FEEDBACK_SCHEMA = "sample_id string, request_id string, source_dataset string, live_source string, model_used string, prediction_score double, predicted_label int, final_reviewed_label int, review_status string, user_reported boolean, analyst_reviewed boolean, false_positive boolean, false_negative boolean, language string, timestamp string, signals_snapshot map<string,string>, notes string, metadata map<string,string>"
PREDICTION_SCHEMA = "sample_id string, source_dataset string, normalized_label int, predicted_label int, score double, normalized_url string, normalized_text string, model_name string"


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION_SCHEMA).json(path)


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEEDBACK_SCHEMA).json(path)

