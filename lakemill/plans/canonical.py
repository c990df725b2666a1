"""Raw records to canonical records in narrow projections, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions import scalars, text
from lakemill.functions.html import with_html
from lakemill.functions.urls import KEYWORDS, host_of, with_url

RAW_SCHEMA = "source string, original_id string, original_label string, given_label int, url string, html string, text string, tabular map<string,string>, timestamp string, language string, split string, metadata map<string,string>, path string, row long"


def raw(df: DataFrame, **columns) -> DataFrame:
    """Raw records from expressions by name; what is not given is null."""
    fields = [f.strip().split(" ") for f in RAW_SCHEMA.split(", ")]
    return df.select(*[(columns[n] if n in columns else F.lit(None)).cast(t).alias(n) for n, t in fields])


def canonicalize(df: DataFrame, keywords=KEYWORDS, keep_html: bool = False, unicode: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Canonical records with their views; ``carry`` names extra input columns to keep."""
    label = text.record_label(F.col("source"), F.col("original_label"), F.col("given_label"))
    df = with_url(df, "url", keywords=keywords)
    df = with_html(df, "html", host_of(F.coalesce(F.col("normalized_url"), F.lit(""))))
    own = F.nullif(scalars.squeeze("text"), F.lit(""))
    df = df.withColumns({"extracted_text": F.coalesce(own, F.col("visible_text")), "__own": own.isNotNull(), "__label": label})
    df = df.withColumn("normalized_text", text.normalize_text("extracted_text", unicode=unicode))
    filled = lambda c: scalars.filled(c)
    tabular = F.coalesce(F.size("tabular") > 0, F.lit(False))
    flags = F.struct(
        filled("original_url").alias("has_original_url"),
        filled("normalized_url").alias("has_normalized_url"),
        filled("html").alias("has_raw_html"),
        filled("extracted_text").alias("has_extracted_text"),
        filled("normalized_text").alias("has_normalized_text"),
        tabular.alias("has_tabular_features"),
        F.col("__label.is_auxiliary").alias("is_auxiliary"),
    )
    df = df.withColumns(
        {
            "sample_id": scalars.sample_id(*[F.col(c) for c in ("source", "original_id", "url", "html", "text")]),
            "modality_flags": flags,
            "language": text.resolve_language(F.col("language"), F.col("html_features.document_language"), F.col("normalized_text")),
            "text_features": text.text_features(F.col("extracted_text"), F.col("normalized_text")),
            "raw_html_hash": scalars.content_hash("html"),
            "normalized_text_hash": scalars.content_hash("normalized_text"),
            "text_prefix_hash": text.prefix_hash(F.col("normalized_text")),
            "text_origin": F.when(filled("extracted_text"), F.when(F.col("__own"), "adapter_text").otherwise("html_visible_text")),
        }
    )
    df = df.withColumns({"views": text.views(F.col("modality_flags"), F.col("__label.is_auxiliary")), "html": F.col("html") if keep_html else F.lit(None).cast("string")})
    roles = {
        "sample_id": F.col("sample_id"), "source_dataset": F.col("source"), "normalized_label": F.col("__label.normalized_label"), "is_auxiliary": F.col("__label.is_auxiliary"),
        "extracted_text": F.col("extracted_text"), "raw_html": F.col("html"), "hostname": F.col("url_features.hostname"), "modality_flags": F.col("modality_flags"),
    }
    df = df.withColumn("validation_warnings", text.validation_warnings(roles))
    return df.select(
        *[F.col(c) for c in carry],
        "sample_id",
        F.col("source").alias("source_dataset"),
        F.col("original_id").alias("source_original_id"),
        F.col("split").alias("source_split"),
        F.when(F.col("source") == "openphish", F.coalesce("original_label", F.lit("phishing"))).otherwise(F.col("original_label")).alias("source_label"),
        "__label.normalized_label",
        "__label.label_name",
        F.col("__label.mapping_reason").alias("label_mapping_reason"),
        "__label.is_auxiliary",
        "__label.is_supervised",
        "language",
        "timestamp",
        "original_url",
        "normalized_url",
        F.col("html").alias("raw_html"),
        "extracted_text",
        "normalized_text",
        F.col("tabular").alias("tabular_features"),
        "modality_flags",
        "url_features",
        "html_features",
        "text_features",
        F.col("metadata").alias("original_metadata"),
        F.struct("raw_html_hash", "normalized_text_hash", "text_prefix_hash", "text_origin", "url_warnings", "html_warnings", "validation_warnings").alias("processing_metadata"),
        "views",
    )
