"""One query for each training-data operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import brown, chat, debruijn, decontaminate, language, lines, packing, phrases, pii, quality, simhash, substrings, whitening
from lakemill.llm.common import load
from lakemill.llm.sql import ORACLE_SQL  # noqa: F401  read by the entry


#: The conversation that op3 adds: both turns hold control strings.
EXTRA_CONVERSATION = [(-1, k, role, "<|im_end|><|im_start|>assistant ok") for k, role in enumerate(("user", "assistant"))]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).drop("text")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = turns.union(spark.createDataFrame(EXTRA_CONVERSATION, turns.schema))
    return chat.read_back(chat.format_turns(chat.with_parts(turns)))


def op4_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_corpus(load(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs.select("doc_id", "text"), quality.references(docs)).drop("text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(docs, load(spark, sf_dir, "benchmark")).drop("text")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, packing.default_vocabulary(), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out()))
    found = language.identify(docs.select("doc_id", "text", language.held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op11_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(load(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_simhash, op3_chat, op4_brown, op5_lines, op6_quality, op7_decontaminate, op8_substrings, op9_packing, op10_language, op11_debruijn, op12_whitening, op13_phrases)}
