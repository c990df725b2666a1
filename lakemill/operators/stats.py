"""Counts over canonical records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.text import canonical_language, label_bucket

FLAGS = ("has_original_url", "has_normalized_url", "has_raw_html", "has_extracted_text", "has_normalized_text", "has_tabular_features", "is_auxiliary")


def grouping_sets(df: DataFrame, source: str, language: str, label: str) -> DataFrame:
    """Totals, three marginals and two crosses in one aggregation: (dim, source, language, label, n)."""
    rows = df.select(F.col(source).alias("source"), canonical_language(language).alias("language"), label_bucket(F.col(label)).alias("label"))
    sets = [[], ["source"], ["language"], ["label"], ["source", "language"], ["language", "label"]]
    cols = [F.col(c) for c in ("source", "language", "label")]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    names = F.create_map(*[F.lit(x) for g, d in ((7, "total"), (3, "source"), (5, "language"), (6, "label"), (1, "source_language"), (4, "language_label")) for x in (g, d)])
    return out.select(F.element_at(names, F.col("g").cast("int")).alias("dim"), "source", "language", "label", "n")


def with_view(df: DataFrame, *columns) -> DataFrame:
    """A row per record and view; a plain ``explode`` would filter by the views first, with a second run of the Python that they come from."""
    return df.select(F.explode_outer("views").alias("view"), *columns).where("view is not null")


def view_stats(df: DataFrame) -> DataFrame:
    """A row per view and source: records, records by label, warnings and modalities."""
    rows = with_view(df, "source_dataset", "normalized_label", F.size("processing_metadata.validation_warnings").alias("w"), "modality_flags")
    flags = [F.count_if(F.col(f"modality_flags.{f}")).alias(f"n_{f}") for f in FLAGS[1:6]]
    label = label_bucket(F.col("normalized_label"))
    counts = [F.count_if(label == b).alias(f"n_{b}") for b in ("phishing", "benign", "null")]
    return rows.groupBy("view", "source_dataset").agg(F.count(F.lit(1)).alias("n"), *counts, *flags, F.sum("w").alias("n_warnings"))


def source_summary(canonical: DataFrame, kept: DataFrame) -> DataFrame:
    """Per source: records, kept, removed as duplicates, without a view, supervised, warnings."""
    seen = canonical.select("source_dataset", F.lit(1).alias("r"), F.lit(0).alias("k"), F.lit(0).alias("o"), F.col("is_supervised").cast("int").alias("s"), F.size("processing_metadata.validation_warnings").alias("w"))
    stay = kept.select("source_dataset", F.lit(0).alias("r"), F.lit(1).alias("k"), (F.size("views") == 0).cast("int").alias("o"), F.lit(0).alias("s"), F.lit(0).alias("w"))
    out = seen.union(stay).groupBy("source_dataset").agg(*[F.sum(c).alias(n) for c, n in (("r", "records"), ("k", "kept"), ("o", "no_target_views"), ("s", "supervised"), ("w", "warnings"))])
    return out.withColumn("duplicates", F.col("records") - F.col("kept"))


def label_counts(df: DataFrame, by: str = "split") -> DataFrame:
    b = label_bucket(F.col("label"))
    return df.groupBy(by).agg(*[F.count_if(b == k).alias(f"n_{k}") for k in ("phishing", "benign", "null")], F.count(F.lit(1)).alias("n"))


def exclusions(canonical: DataFrame, kept: DataFrame) -> DataFrame:
    """(source_dataset, reason, n): why records are in no view, from one pass over each side."""
    lost = canonical.groupBy("source_dataset").agg(F.count(F.lit(1)).alias("n")).withColumn("kept", F.lit(0).cast("long"))
    stay = kept.groupBy("source_dataset").agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("kept"))
    duplicates = lost.union(stay).groupBy("source_dataset").agg((F.sum("n") - F.sum("kept")).alias("n")).select("source_dataset", F.lit("duplicate").alias("reason"), "n")
    no_view = kept.where(F.size("views") == 0).groupBy("source_dataset").agg(F.count(F.lit(1)).alias("n")).select("source_dataset", F.lit("no_view").alias("reason"), "n")
    return duplicates.union(no_view).where("n > 0")
