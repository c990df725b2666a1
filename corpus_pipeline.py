"""From raw documents to packed training sequences, in five stages.

Every stage works on all that its predecessor kept, which is written as Parquet and read again in
between. All but the last return the columns of ``documents``; extra columns of the input are left
out. An empty table passes through all stages. Rows with a null doc_id, or one that others have, are documents
of their own; rows equal in doc_id and text are one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import decontaminate, language, lines, packing, simhash
from lakemill.llm.common import keyed, load, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text that the codes cannot tell apart goes only if its best language has less than this.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language: without a letter, or ambiguous with a low score."""
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.fit(docs.where(~language.held_out())))
    lost = (F.col("lang_pred") == language.UNDETERMINED) | F.col("ambiguous") & (F.col("score") < LEAST_SCORE)
    return found.where(~lost).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of near-equal lines; a document that loses all its words goes."""
    found = lines.dedup(docs.select(*COLUMNS))
    emptied = (F.col("n_lines_removed") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    return found.where(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every SimHash component: the one with the least id, null ids first, then by a hash of the text."""
    _, distinct = keyed(docs.select(*COLUMNS), "rid")
    found = simhash.near_duplicates(distinct.select(F.col("rid").alias("doc_id"), "text"))
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("rid"))
    return distinct.join(kept, "rid", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    found = decontaminate.find_contamination(docs.select(*COLUMNS), load(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents left, with their places in sequences."""
    import public_tokenizers

    return packing.pack(docs, packing.default_vocabulary(), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_documents),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: SQL cannot express the stages; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
