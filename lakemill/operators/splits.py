"""Train, validation and test splits that depend on content and a seed alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.times import normalized_time
from lakemill.operators.ranks import ranked
from lakemill.operators.storage import cut

TEST, VALIDATION, SEED = 0.2, 0.1, 42


def _ordering(id_col: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def _round_even(n: Column, fraction: float) -> Column:
    return F.greatest(F.lit(1), F.bround(n * F.lit(fraction), 0).cast("long"))


def _named(rank: Column, test: Column, validation: Column) -> Column:
    return F.when(rank <= test, "test").when(rank <= test + validation, "validation").otherwise("train")


def _global_rank(df: DataFrame, order: list, name: str) -> DataFrame:
    """Rank over all rows without one task for all: range partitions, their sizes as offsets."""
    cols = [f"__o{k}" for k in range(len(order))]
    rows = df.withColumns({c: o for c, o in zip(cols, order)}).repartitionByRange(*cols)
    rows = cut(rows.withColumn("__p", F.spark_partition_id()), "rank")  # partitions must be the same in both uses
    sizes = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__b", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__b")
    inner = F.row_number().over(Window.partitionBy("__p").orderBy(*cols))
    return rows.withColumn("__r", inner).join(F.broadcast(before), "__p").withColumn(name, F.col("__r") + F.col("__b")).drop("__p", "__r", "__b", *cols)


def stratified(df: DataFrame, id_col: str, label_col: str, test: float = TEST, validation: float = VALIDATION, seed: int = SEED) -> DataFrame:
    """Exact sizes within every label."""
    rows = ranked(df, [label_col], _ordering(id_col, seed), [id_col], "__r", "__n")
    return rows.withColumn("split", _named(F.col("__r"), _round_even(F.col("__n"), test), _round_even(F.col("__n"), validation))).drop("__n", "__r")


def unstratified(df: DataFrame, id_col: str, test: float = TEST, validation: float = VALIDATION, seed: int = SEED) -> DataFrame:
    """Sizes rounded up, whatever the labels."""
    rows = ranked(df, [], _ordering(id_col, seed), [id_col], "__r", "__n")
    t = F.ceil(F.col("__n") * F.lit(test))
    return rows.withColumn("split", _named(F.col("__r"), t, F.ceil((F.col("__n") - t) * F.lit(_share(test, validation))))).drop("__n", "__r")


def _share(test: float, validation: float) -> float:
    """What validation takes of the rows that are not test."""
    return validation / max(1e-9, 1 - test)


def can_stratify(df: DataFrame, label_col: str) -> bool:
    """Whether all labels are 0 or 1 and there are two rows of both."""
    label = F.col(label_col)
    r = df.agg(F.count_if(label == 0).alias("zero"), F.count_if(label == 1).alias("one"), F.count(F.lit(1)).alias("n")).first()
    return r["zero"] + r["one"] == r["n"] and min(r["zero"], r["one"]) > 1


def random_rows(df: DataFrame, id_col: str, label_col: str, test: float = TEST, validation: float = VALIDATION, seed: int = SEED) -> tuple[DataFrame, bool]:
    """Stratified where the labels allow it, and whether they did."""
    if can_stratify(df, label_col):
        return stratified(df, id_col, label_col, test, validation, seed), True
    return unstratified(df, id_col, test, validation, seed), False


def by_group(df: DataFrame, group: Column, test: float = TEST, validation: float = VALIDATION, seed: int = SEED, id_col: str | None = None) -> DataFrame:
    """No group lies in two splits; the fractions are of groups. A single group is all train.

    Where test leaves one group and ``id_col`` is given, that group's rows are split between train and validation.
    """
    rows = df.withColumn("__g", group.cast("string"))
    groups = rows.select("__g").distinct()
    ranked_ = _global_rank(groups, [_ordering("__g", seed), F.col("__g")], "__rank")
    n = groups.count()
    ranked_ = ranked_.withColumn("__n", F.lit(n))
    t = F.ceil(F.col("__n") * F.lit(test))
    v = F.ceil((F.col("__n") - t) * F.lit(_share(test, validation)))
    named = ranked_.withColumn("split", F.when(F.col("__n") <= 1, "train").otherwise(_named(F.col("__rank"), t, v))).select("__g", "split")
    out = rows.join(named, "__g").drop("__g")
    if id_col is None or n != 2:
        return out
    left = ranked(out.where("split <> 'test'"), [], _ordering(id_col, seed), [id_col], "__r", "__n")
    left = left.withColumn("split", F.when(F.col("__r") <= F.ceil(F.col("__n") * F.lit(_share(test, validation))), "validation").otherwise("train")).drop("__r", "__n")
    return out.where("split = 'test'").unionByName(left)


def domain_group(registered: Column, hostname: Column, source: Column) -> Column:
    return F.coalesce(F.nullif(registered, F.lit("")), F.nullif(hostname, F.lit("")), F.nullif(source, F.lit("")), F.lit("unknown_domain"))


def time_aware(df: DataFrame, id_col: str, ts_text: Column, test: float = TEST, validation: float = VALIDATION) -> DataFrame:
    """The latest block is test, the one before validation; rows without a time come last, by id.

    Times are ordered in their normal form (``functions.times``), so date-only stamps, ``Z`` and fractions have their place.
    """
    rows = df.withColumn("__t", normalized_time(ts_text))
    missing = F.col("__t").isNull().cast("int")
    ranked = _global_rank(rows, [missing, F.coalesce("__t", F.col(id_col).cast("string")), F.col(id_col)], "__rank").drop("__t")
    rows = ranked.withColumn("__n", F.lit(df.count()))
    t, v = _round_even(F.col("__n"), test), _round_even(F.col("__n"), validation)
    split = F.when(F.col("__rank") > F.col("__n") - t, "test").when(F.col("__rank") > F.col("__n") - t - v, "validation").otherwise("train")
    return rows.withColumn("split", split).drop("__rank", "__n")


def source_split(split_col: str) -> Column:
    """The split that a source names, or null."""
    key = F.lower(F.trim(F.col(split_col)))
    return F.when(key.isin("val", "dev", "validation"), "validation").when(key.isin("train", "test"), key)


def predefined(df: DataFrame, split_col: str) -> DataFrame:
    """The source's own splits; other names are train."""
    return df.withColumn("split", F.coalesce(source_split(split_col), F.lit("train")))


def repair_empty(df: DataFrame, id_col: str) -> DataFrame:
    """With three rows or more, no split is empty: the last train rows by id go to test, then validation."""
    counts = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    missing = [s for s in ("test", "validation") if not counts.get(s)]
    if not missing or sum(counts.values()) < 3 or counts.get("train", 0) <= len(missing):
        return df
    last = df.where("split = 'train'").orderBy(F.col(id_col).desc()).limit(len(missing)).select(id_col).collect()
    for name, row in zip(missing, last):
        df = df.withColumn("split", F.when((F.col("split") == "train") & (F.col(id_col) == row[0]), name).otherwise(F.col("split")))
    return df


# Why a strategy gives way to a random split.
TOO_FEW_ROWS, ONE_GROUP, NO_SOURCE_SPLITS = "dataset_too_small_for_temporal_holdout", "insufficient_distinct_groups", "missing_or_incomplete_source_splits"


def split_with_report(
    df: DataFrame, strategy: str, id_col: str, label_col: str, group: Column | None = None, ts_text: Column | None = None, split_col: str = "source_split", test: float = TEST, validation: float = VALIDATION, seed: int = SEED
) -> tuple[DataFrame, dict]:
    """Rows with ``split``, and what was done: the strategy asked for and taken, ``fallback_reason``, coverage, and counts by split and label.

    Times that are too few for a block each, a single group, and sources without test rows fall back on a random split,
    which is stratified if all labels are 0 or 1.
    """
    n = df.count()
    if not n:
        raise ValueError("cannot split an empty dataset")
    report: dict = {"requested_strategy": strategy, "strategy": strategy, "seed": seed, "test_fraction": test, "validation_fraction": validation}
    reason = made = None
    if strategy == "group":
        report["group_count"] = df.select(group.cast("string").alias("g")).distinct().count()
        reason = ONE_GROUP if report["group_count"] <= 1 else None
        made = None if reason else by_group(df, group, test, validation, seed, id_col)
    elif strategy == "time_aware":
        report["timestamp_coverage"] = df.where(normalized_time(ts_text).isNotNull()).count()
        held = sum(max(1, round(n * f)) for f in (test, validation))
        reason = TOO_FEW_ROWS if n <= held else None
        made = None if reason else time_aware(df, id_col, ts_text, test, validation)
    elif strategy == "predefined":
        own = source_split(split_col)
        r = df.agg(F.count(own).alias("named"), F.count_if(own == "test").alias("test")).first()
        report["passthrough_count"] = r["named"]
        reason = None if r["test"] else NO_SOURCE_SPLITS
        made = None if reason else predefined(df, split_col)
    elif strategy != "stratified":
        raise ValueError(f"unknown strategy {strategy!r}")
    if made is None:
        made, even = random_rows(df, id_col, label_col, test, validation, seed)
        report |= {"strategy": "stratified" if even else "unstratified", "fallback_reason": reason}
    made = repair_empty(made, id_col)
    counts = made.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label_col) == 1).alias("phishing"), F.count_if(F.col(label_col) == 0).alias("benign")).collect()
    by_split = {r["split"]: r for r in counts}
    report["counts"] = {s: by_split[s]["n"] if s in by_split else 0 for s in ("train", "validation", "test")}
    report["label_counts"] = {s: {"phishing": r["phishing"], "benign": r["benign"], "null": r["n"] - r["phishing"] - r["benign"]} for s, r in by_split.items()}
    return made, report


def split(df: DataFrame, strategy: str, id_col: str, label_col: str, group: Column | None = None, ts_text: Column | None = None, split_col: str = "source_split") -> DataFrame:
    return split_with_report(df, strategy, id_col, label_col, group, ts_text, split_col)[0]
