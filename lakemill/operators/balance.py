"""Rebalancing of languages and labels by hash rank."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalars import hash_fraction, hash_hex
from lakemill.functions.text import canonical_language, label_bucket
from lakemill.operators.ranks import ranked

ENGLISH_SHARE, LEAST_ENGLISH = 0.60, 50_000


def english_prefilter(df: DataFrame, id_col: str, keep: float = 0.32, source: str | None = None) -> DataFrame:
    """Keep a hash share of English rows (of one source, if named) and all others."""
    english = canonical_language("lang") == "en"
    if source is not None:
        english = english & (F.col("source") == source)
    return df.where(~(english & (hash_fraction(F.col(id_col), "english_prefilter:") > keep)))


def english_cap(english: int, others: int, share: float = ENGLISH_SHARE, least: int = LEAST_ENGLISH) -> int:
    return english if not others else min(english, max(least, math.floor(others * share / (1 - share))))


def allocate(counts: dict[str, int], target: int) -> dict[str, int]:
    """Largest remainders: whole parts first, then one each by fraction, then label, both descending; never above the count."""
    total = sum(counts.values())
    if not total or target >= total:
        return dict(counts)
    exact = {k: target * n / total for k, n in counts.items()}
    out = {k: min(counts[k], math.floor(x)) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (exact[k] - math.floor(exact[k]), k), reverse=True):
        if sum(out.values()) >= target:
            break
        out[k] += out[k] < counts[k]
    return out


def top_by_hash(df: DataFrame, id_col: str, label_col: str, targets: dict[str, int]) -> DataFrame:
    """Of each label the target number of rows with the least hash of their id."""
    if not targets:
        return df.limit(0)
    wanted = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
    rows = ranked(df, [label_col], hash_hex(F.col(id_col)), [F.col(id_col).desc()], "__r", "__n")
    return rows.where(F.col("__r") <= F.coalesce(F.try_element_at(wanted, F.col(label_col)), F.lit(0))).drop("__r", "__n")


def rebalance(df: DataFrame, id_col: str = "sample_id", lang_col: str = "language", label_col: str = "normalized_label", share: float = ENGLISH_SHARE, least: int = LEAST_ENGLISH) -> DataFrame:
    """Cap English rows at a share of all, by label in proportion, by hash within a label."""
    rows = df.withColumns({"__en": canonical_language(lang_col) == "en", "__label": label_bucket(F.col(label_col))})
    found = rows.groupBy("__en", "__label").agg(F.count(F.lit(1)).alias("n")).collect()
    english = {r["__label"]: r["n"] for r in found if r["__en"]}
    others = sum(r["n"] for r in found if not r["__en"])
    targets = allocate(english, english_cap(sum(english.values()), others, share, least))
    picked = top_by_hash(rows.where("__en"), id_col, "__label", targets)
    return rows.where("not __en").unionByName(picked).drop("__en", "__label")


def oversample(df: DataFrame, id_col: str, group_cols: list[str], target: int) -> DataFrame:
    """Fill every group up to ``target`` rows with copies taken round robin in hash order.

    Copies get the suffix ``::dup::k``. How often a row is copied follows from its rank.
    """
    rows = ranked(df, group_cols, hash_hex(F.col(id_col)), [id_col], "__r", "__n").withColumn("__r", F.col("__r") - 1)
    rows = rows.withColumn("__need", F.greatest(F.lit(target) - F.col("__n"), F.lit(0)))
    copies = F.when(F.col("__need") > F.col("__r"), F.ceil((F.col("__need") - F.col("__r")) / F.col("__n"))).otherwise(0).cast("int")
    rows = rows.withColumn("__k", F.explode(F.sequence(F.lit(0), copies)))
    number = F.col("__r") + (F.col("__k") - 1) * F.col("__n") + 1
    made = F.when(F.col("__k") > 0, F.concat(F.col(id_col).cast("string"), F.lit("::dup::"), number.cast("string"))).otherwise(F.col(id_col).cast("string"))
    return rows.withColumns({id_col: made, "resampled": F.col("__k") > 0}).drop("__n", "__r", "__need", "__k")
