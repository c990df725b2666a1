"""Streaming over prediction feeds: risk levels, windowed drift counts, dedup within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators.metrics import apply_risk


def score_stream(stream: DataFrame, low: float = 0.3, high: float = 0.7) -> DataFrame:
    """Risk level and predicted label per row; stateless, so it runs in any trigger mode."""
    return apply_risk(stream, "score", low, high)


def windowed_levels(stream: DataFrame, ts: str = "ts", late: str | None = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts by tumbling window and risk level; rows later than the watermark are dropped.

    A stream that has been through :func:`dedup_stream` keeps its watermark: pass ``late=None`` then.
    """
    stream = stream.withWatermark(ts, late) if late else stream
    return stream.groupBy(F.window(ts, width), "risk_level").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score")).select(F.col("window.start").alias("start"), "risk_level", "n", "mean_score")


def dedup_stream(stream: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """First of each key within the watermark; state is bounded by it."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
