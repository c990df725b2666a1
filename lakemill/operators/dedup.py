"""First-seen dedup over several keys, with the results of a sequential pass.

A row goes if it shares a key with an earlier row that stays; keys of rows that go do not count. Rounds:
a row that is first among the undecided at every key of its own stays, and rows that share a key with
it go. That is the order-first greedy set, whatever the partitioning. Long chains, in which each row waits for
the one before, would take a round for every other row. A row that waits for a single earlier row stays just if that
one goes; so after some rounds such rows are followed to where their chain begins by pointer doubling, and a chain of n rows takes log n
joins of many tasks. Only what still is open after that, rows that wait for several others which wait in turn, is passed in
order, component by component.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.components import components
from lakemill.operators.storage import cut, discard

KEY_TYPES = ("source_original_id", "original_url", "normalized_url", "raw_html_hash", "normalized_text_hash")


def scope(flags: Column, is_auxiliary: Column) -> Column:
    return F.when(is_auxiliary, "auxiliary").when(flags["has_tabular_features"] & ~flags["has_original_url"], "tabular").otherwise("supervised")


def canonical_keys(df: DataFrame, key_types: tuple[str, ...] = KEY_TYPES) -> DataFrame:
    """(seq, key) of canonical records with a ``seq``; a key is prefixed by scope and type."""
    values = {
        "source_original_id": F.when(F.col("source_original_id") != "", F.concat("source_dataset", F.lit(":"), "source_original_id")),
        "original_url": F.nullif("original_url", F.lit("")),
        "normalized_url": F.nullif("normalized_url", F.lit("")),
        "raw_html_hash": F.col("processing_metadata.raw_html_hash"),
        "normalized_text_hash": F.col("processing_metadata.normalized_text_hash"),
    }
    of = scope(F.col("modality_flags"), F.col("is_auxiliary"))
    keys = F.array_compact(F.array(*[F.when(values[t].isNotNull(), F.concat(of, F.lit("|" + t + "|"), values[t])) for t in key_types]))
    return df.select("seq", F.explode(keys).alias("key"))


#: Rounds before what is left is passed in order, and how many of them do not follow chains.
ROUNDS, PLAIN_ROUNDS = 12, 4


def first_seen(keys: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(seq, kept) of all rows of (seq, key) that hold a key; rows without one always stay.

    Keys that occur once decide nothing and are left out first.
    """
    keys = keys.distinct()
    repeated = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    open_rows = cut(keys.join(repeated, "key", "left_semi"), "dedup-open")
    alone = keys.select("seq").distinct().join(open_rows.select("seq").distinct(), "seq", "left_anti")
    decided = [cut(alone.select(F.col("seq").cast("long"), F.lit(True).alias("kept")), "dedup-decided")]
    for k in range(rounds):
        if open_rows.isEmpty():
            break
        stay = cut(_first(open_rows) if k < PLAIN_ROUNDS else _along_chains(open_rows), "dedup-stay")
        used = open_rows.join(stay, "seq", "left_semi").select("key").distinct()
        hit = open_rows.join(used, "key", "left_semi").select("seq").distinct()
        done = cut(hit.join(stay.withColumn("kept", F.lit(True)), "seq", "left").select(F.col("seq").cast("long"), F.coalesce("kept", F.lit(False)).alias("kept")), "dedup-decided")
        decided.append(done)
        before, open_rows = open_rows, cut(open_rows.join(done, "seq", "left_anti"), "dedup-open")
        discard(before, stay)
    if not open_rows.isEmpty():
        decided.append(cut(_in_order(open_rows), "dedup-decided"))
    out = keys.sparkSession.read.schema("seq long, kept boolean").parquet(*[d.written_to for d in decided])
    return out.select(F.col("seq").cast(keys.schema["seq"].dataType).alias("seq"), "kept")


def _first(open_rows: DataFrame) -> DataFrame:
    """(seq) of the rows that are first at every key of their own."""
    first = open_rows.groupBy("key").agg(F.min("seq").alias("least"))
    return open_rows.join(first, "key").groupBy("seq").agg(F.bool_and(F.col("seq") == F.col("least")).alias("kept")).where("kept").select("seq")


def _along_chains(open_rows: DataFrame) -> DataFrame:
    """(seq) of the rows that stay: the first ones, and every other row of the chains that begin at them.

    Two minima a key, with map-side aggregation, tell whether a row has none, one or more rows before it.
    """
    first = open_rows.groupBy("key").agg(F.min("seq").alias("least"))
    rows = open_rows.join(first, "key")
    second = rows.where("seq > least").groupBy("key").agg(F.min("seq").alias("second"))
    rows = rows.join(second, "key", "left")
    of_row = rows.groupBy("seq").agg(F.bool_or((F.col("seq") > F.col("least")) & (F.col("seq") > F.col("second"))).alias("more"), F.min(F.when(F.col("seq") > F.col("least"), F.col("least"))).alias("lo"), F.max(F.when(F.col("seq") > F.col("least"), F.col("least"))).alias("hi"))
    of_row = cut(of_row, "dedup-waits")
    starts = of_row.where("not more and lo is null").select("seq")
    chain = cut(of_row.where("not more and lo = hi").select("seq", F.col("lo").alias("to"), F.lit(True).alias("odd")), "dedup-chain")
    while True:
        on = chain.select(F.col("seq").alias("s"), F.col("to").alias("t"), F.col("odd").alias("o"))
        joined = chain.join(on, F.col("to") == F.col("s"), "left")
        further = cut(joined.select("seq", F.coalesce("t", "to").alias("to"), (F.col("odd") != F.coalesce("o", F.lit(False))).alias("odd"), F.col("t").isNotNull().alias("moved")), "dedup-chain")
        discard(chain)
        chain = further
        if chain.where("moved").isEmpty():
            break
    kept = chain.where("not odd").join(starts.withColumnRenamed("seq", "to"), "to", "left_semi").select("seq")
    stay = cut(starts.union(kept), "dedup-stay")
    discard(of_row, chain)
    return stay


def _in_order(open_rows: DataFrame) -> DataFrame:
    """(seq, kept) by a sequential pass over the rows of each component; a task holds the keys that one component has used."""
    least = open_rows.groupBy("key").agg(F.min("seq").alias("least"))
    edges = open_rows.join(least, "key").select(F.col("seq").alias("a"), F.col("least").alias("b"))
    roots = components(edges, "dedup").withColumnRenamed("node", "seq")
    rows = open_rows.groupBy("seq").agg(F.collect_list("key").alias("keys")).join(roots, "seq")
    rows = rows.repartition("root").sortWithinPartitions("root", "seq").select("root", F.col("seq").cast("long"), "keys")

    def run(batches):
        now, used = None, set()
        for batch in batches:
            seqs, kept = [], []
            for root, seq, keys in zip(*(c.to_pylist() for c in batch.columns)):
                if root != now:
                    now, used = root, set()
                seqs.append(seq)
                kept.append(used.isdisjoint(keys))
                if kept[-1]:
                    used.update(keys)
            yield pa.RecordBatch.from_arrays([pa.array(seqs, pa.int64()), pa.array(kept, pa.bool_())], ["seq", "kept"])

    return rows.mapInArrow(run, "seq long, kept boolean")


def events(keys: DataFrame, decided: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per removed row: the least id among the earlier kept rows it matches, and the matched keys.

    ``ids`` has (seq, sample_id).
    """
    kept = decided.where("kept").select("seq").join(ids, "seq").join(keys.distinct(), "seq").select("key", F.col("seq").alias("kept_seq"), F.col("sample_id").alias("kept_sample_id"))
    gone = decided.where("not kept").select("seq").join(keys.distinct(), "seq")
    matched = gone.join(kept, "key").where("kept_seq < seq")
    per_row = matched.groupBy("seq").agg(F.min("kept_sample_id").alias("kept_sample_id"), F.array_sort(F.collect_set(F.split_part("key", F.lit("|"), F.lit(2)))).alias("matched_on"), F.array_sort(F.collect_set("key")).alias("keys"))
    return per_row.join(ids, "seq").select("seq", F.col("sample_id").alias("removed_sample_id"), "kept_sample_id", "matched_on", "keys")


def deduplicate(df: DataFrame, enabled: bool = True, key_types: tuple[str, ...] = KEY_TYPES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept canonical records (with seq), removal events and a summary per scope and key type."""
    ids = df.select("seq", "sample_id")
    marks = df.select("seq", F.struct(F.col("url_features.registered_domain").alias("registered_domain"), F.col("processing_metadata.text_prefix_hash").alias("normalized_text_prefix_hash")).alias("candidate_signatures"))
    keys = canonical_keys(df, key_types)
    decided = first_seen(keys) if enabled else df.select("seq", F.lit(True).alias("kept"))
    kept = df.join(decided.where("not kept").select("seq"), "seq", "left_anti")
    found = events(keys, decided, ids).join(marks, "seq")
    by = found.select(F.explode("keys").alias("key")).select(F.split_part("key", F.lit("|"), F.lit(1)).alias("scope"), F.split_part("key", F.lit("|"), F.lit(2)).alias("matched_on"))
    return kept, found, by.groupBy("scope", "matched_on").agg(F.count(F.lit(1)).alias("removed"))
