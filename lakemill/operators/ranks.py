"""Ranks and running sums within groups of any size.

A window over a group is one task for all its rows. Here rows fall into buckets that follow the order;
a group's buckets are summed, and only rows of one bucket are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a group, at most; a power of 16.
BUCKETS = 4096


def score_bucket(score: Column) -> Column:
    """Buckets that go up with any number; scores from 0 to 1 have BUCKETS of them."""
    return F.floor(F.atan(score.cast("double")) * F.lit(BUCKETS * 1.27323954))


def hash_bucket(hex_digest: Column) -> Column:
    """The first three digits of a hexadecimal digest, which all have as many rows."""
    return F.substring(hex_digest, 1, 3)


def running(df: DataFrame, groups: list[str], bucket: Column, order: list, sums: dict[str, str], totals: dict[str, str], descending: bool = False) -> DataFrame:
    """``df`` with sums up to and including each row (``sums``: name to column) and over its whole group (``totals``).

    ``bucket`` must go up with ``order`` (down, if ``descending``); rows that are equal in ``order`` are in no fixed one.
    """
    rows = df.withColumn("__bucket", bucket)
    needed = sorted(set(sums.values()) | set(totals.values()))
    by_bucket = rows.groupBy(*groups, "__bucket").agg(*[F.sum(c).alias(f"__sum_{c}") for c in needed])
    part = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = part.orderBy(F.desc("__bucket") if descending else F.asc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"__sum_{c}").over(earlier), F.lit(0)).alias(f"__before_{n}") for n, c in sums.items()]
    whole = [F.sum(f"__sum_{c}").over(part).alias(n) for n, c in totals.items()]
    keys = [*groups, "__bucket"]
    offsets = by_bucket.select(*[F.col(f"`{k}`").alias(f"__key_{i}") for i, k in enumerate(keys)], *before, *whole)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(keys)]
    joined = rows.join(offsets, same).drop(*[f"__key_{i}" for i in range(len(keys))])
    inside = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = joined.withColumns({n: F.sum(c).over(inside) + F.col(f"__before_{n}") for n, c in sums.items()})
    return out.drop("__bucket", *[f"__before_{n}" for n in sums])


def ranked(df: DataFrame, groups: list[str], digest: Column, ties: list, rank: str, n: str) -> DataFrame:
    """``df`` with each row's rank by ``digest``, then ``ties``, within its group, and the group's number of rows."""
    rows = df.withColumns({"__one": F.lit(1), "__digest": digest})
    return running(rows, groups, hash_bucket(F.col("__digest")), ["__digest", *ties], {rank: "__one"}, {n: "__one"}).drop("__one", "__digest")
