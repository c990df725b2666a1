"""Binary classification metrics, threshold tables, risk buckets and threshold choice.

Predictions have label (0/1) and score; group columns, if any, get a row each. All curves come from
one histogram of scores, so ties are handled as one point, and from running sums over its distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.ranks import running, score_bucket

MOST_THRESHOLDS = 200


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    precision, recall = _zero(ratio(tp, tp + fp)), _zero(ratio(tp, tp + fn))
    return {
        "accuracy": ratio(tp + tn, tp + fp + tn + fn),
        "precision": precision,
        "recall": recall,
        "f1": _zero(ratio(2 * tp, 2 * tp + fp + fn)),
        "false_positive_rate": ratio(fp, fp + tn),
        "false_negative_rate": ratio(fn, fn + tp),
    }


def confusion(df: DataFrame, groups: list[str] = [], label: str = "label", predicted: str = "predicted") -> DataFrame:  # noqa: B006
    y, p = F.col(label), F.col(predicted)
    c = {"tn": (y == 0) & (p == 0), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tp": (y == 1) & (p == 1)}
    out = df.groupBy(*groups).agg(*[F.count_if(v).alias(k) for k, v in c.items()], F.count(F.lit(1)).alias("n"))
    return out.withColumns(rates(*[F.col(k) for k in ("tp", "fp", "tn", "fn")]))


def histogram(df: DataFrame, groups: list[str] = [], label: str = "label", score: str = "score") -> DataFrame:  # noqa: B006
    """(groups, score, pos, neg) of labelled rows with a score."""
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    return rows.groupBy(*groups, F.col(score).alias("score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def _cumulated(h: DataFrame, groups: list[str] = []) -> DataFrame:  # noqa: B006
    """Histogram rows with the positives and negatives from their score up (tp, fp) and in all (p, q)."""
    return running(h, groups, score_bucket(F.col("score")), [F.desc("score")], {"tp": "pos", "fp": "neg"}, {"p": "pos", "q": "neg"}, descending=True)


def curve_areas(df: DataFrame, groups: list[str] = [], label: str = "label", score: str = "score") -> DataFrame:  # noqa: B006
    """roc_auc by ranks with ties halved, pr_auc as step-wise average precision; null with one class."""
    h = histogram(df, groups, label, score)
    h = _cumulated(h, groups)
    one = F.col("pos") * (F.col("q") - F.col("fp") + F.col("neg") / 2.0)
    step = F.col("pos") / F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))
    out = h.groupBy(*groups).agg(F.first("p").alias("p"), F.first("q").alias("q"), F.sum(one).alias("a"), F.sum(F.when(F.col("p") > 0, step)).alias("b"))
    both = (F.col("p") > 0) & (F.col("q") > 0)
    return out.select(*groups, F.when(both, F.col("a") / F.nullif(F.col("p") * F.col("q"), F.lit(0))).alias("roc_auc"), F.when(both, F.col("b")).alias("pr_auc"))


def thresholds(h: DataFrame, most: int = MOST_THRESHOLDS) -> DataFrame:
    """0, 0.5, 1 and the distinct scores, or evenly spaced ones if those are too many."""
    spark = h.sparkSession
    spaced = spark.range(most).select(F.round(F.col("id") / F.lit(most - 1.0), 6).alias("threshold"))
    few = h.select("score").distinct().limit(most + 1)
    if few.count() > most:
        return spaced.union(spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "threshold double")).distinct()
    return few.select(F.col("score").cast("double").alias("threshold")).union(spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "threshold double")).distinct()


def threshold_table(df: DataFrame, label: str = "label", score: str = "score", most: int = MOST_THRESHOLDS) -> DataFrame:
    """Counts and rates at each threshold, a score being positive from the threshold up.

    Thresholds and score histogram go through one cumulative window, not a join of each with each.
    """
    h = histogram(df, [], label, score)
    t = thresholds(h, most).select(F.col("threshold").alias("score"), F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"), F.lit(True).alias("t"))
    both = h.select(F.col("score").cast("double").alias("score"), "pos", "neg", F.lit(False).alias("t")).union(t).groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.bool_or("t").alias("t"))
    out = _cumulated(both).where("t").select(F.round("score", 6).alias("threshold"), "tp", "fp", (F.col("q") - F.col("fp")).alias("tn"), (F.col("p") - F.col("tp")).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    out = out.withColumns(rates(tp, fp, tn, fn))
    return out.withColumns({"low_count": tn + fn, "high_count": tp + fp, "low_rate": ratio(fn, tn + fn), "high_precision": ratio(tp, tp + fp), "low_npv": ratio(tn, tn + fn)})


def pick_threshold(table: DataFrame, objective: str, floor: float | None = None, strict_zero_fpr: bool = False) -> DataFrame:
    """One row: the first best threshold in ascending order.

    A false-positive rate of zero counts as unknown, and so as worst, unless ``strict_zero_fpr``.
    """
    if objective == "recall_under_precision_floor":
        ok, order = F.col("precision") >= (0.9 if floor is None else floor), [F.desc("recall"), F.desc("f1")]
    elif objective == "min_false_positives_under_recall":
        fpr = F.col("false_positive_rate") if strict_zero_fpr else F.nullif(F.col("false_positive_rate"), F.lit(0.0))
        ok, order = F.col("recall") >= (0.8 if floor is None else floor), [F.coalesce(fpr, F.lit(float("inf"))), F.desc("f1")]
    elif objective == "maximize_f1":
        ok, order = F.lit(True), [F.desc("f1")]
    else:
        raise ValueError(f"unknown objective {objective!r}")
    # rows that meet the floor come first; if none does, all compete
    return table.orderBy(F.when(ok, 0).otherwise(1), *order, "threshold").limit(1).withColumn("objective", F.lit(objective))


def risk_thresholds(table: DataFrame, binary: float, most_rate: float = 0.05, least_coverage: float = 0.1, high: str = "binary_threshold", precision_floor: float = 0.9, recall_floor: float = 0.0) -> tuple[float, float]:
    """(low, high): the low one covers most rows while few of them are phishing."""
    rows = table.select("threshold", "low_count", "high_count", "low_rate", "high_precision", "recall").collect()
    total = max((r["low_count"] + r["high_count"] for r in rows), default=0)
    eligible = [r for r in rows if r["threshold"] <= binary]
    good = [(r["low_count"] / total, r["threshold"]) for r in eligible if total and r["low_rate"] is not None and r["low_rate"] <= most_rate and r["low_count"] / total >= least_coverage]
    low = max(good)[1] if good else max((r["threshold"] for r in eligible), default=binary)
    top = binary
    if high == "min_precision_floor":
        top = min((r["threshold"] for r in rows if (r["high_precision"] or 0) >= precision_floor and (r["recall"] or 0) >= recall_floor), default=binary)
    return float(low), float(top)


def risk_bucket(score: Column, low: float = 0.3, high: float = 0.7) -> Column:
    return F.when(score.isNull(), "unknown").when(score < low, "low").when(score >= high, "high").otherwise("medium")


def apply_risk(df: DataFrame, score: str = "score", low: float = 0.3, high: float = 0.7, binary: float | None = None) -> DataFrame:
    s = F.col(score)
    return df.withColumns({"risk_level": risk_bucket(s, low, high), "predicted": F.when(s.isNotNull(), (s >= (high if binary is None else binary)).cast("int"))})


def risk_summary(df: DataFrame, low: float = 0.3, high: float = 0.7, label: str = "label", score: str = "score") -> DataFrame:
    rows = df.where(F.col(score).isNotNull()).withColumn("bucket", risk_bucket(F.col(score), low, high))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("phishing"), F.count_if(F.col(label) == 0).alias("benign"))


def calibrate(df: DataFrame, objective: str = "maximize_f1", label: str = "label", score: str = "score", most_rate: float = 0.05, least_coverage: float = 0.1) -> dict:
    """Thresholds, buckets and warnings of a risk mapping."""
    table = threshold_table(df, label, score).cache()
    chosen = pick_threshold(table, objective).first()
    if chosen is None or not chosen["tp"] + chosen["fp"] + chosen["tn"] + chosen["fn"]:
        raise ValueError("no labelled rows with a score")
    binary = float(chosen["threshold"])
    low, high = risk_thresholds(table, binary, most_rate, least_coverage)
    buckets = {r["bucket"]: r.asDict() for r in risk_summary(df, low, high, label, score).collect()}
    thin = high - low < 0.05 or buckets.get("medium", {}).get("n", 0) < 10
    table.unpersist()
    return {"binary_threshold": binary, "low_threshold": low, "high_threshold": high, "objective": objective, "buckets": buckets, "warnings": ["degenerate_three_level_mapping"] if thin else []}


def score_histogram(df: DataFrame, bins: int = 29, score: str = "score", groups: list[str] = []) -> DataFrame:  # noqa: B006
    """Counts by bin over 0 to 1, the last bin closed on the right."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.where(F.col(score).between(0, 1)).groupBy(*groups, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def curve_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The data of precision-recall and ROC plots: one point per distinct score."""
    h = histogram(df, [], label, score)
    return _cumulated(h).select("score", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("p")).alias("recall"), ratio(F.col("fp"), F.col("q")).alias("false_positive_rate"))
