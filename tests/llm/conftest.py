"""Tables of odd rows, and empty ones."""

import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CHAT = "conv_id long, turn long, role string, text string"
ODD = [None, "", " ", "\n\n", "a", "1234 !!", "x " * 5000, "Ünïcode ßtraße ½ ²", "tab\tone\x0btwo\x1cthree", "q" * 120_000]


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Odd rows: nulls, empty, long and repeated texts, a null id, clashing extra columns."""
    d = str(tmp_path_factory.mktemp("odd"))
    rows = [(i, t, None if i % 3 == 0 else "en", None, None) for i, t in enumerate(ODD)]
    rows += [(50, "same row twice " * 4, "en", "s", 1)] * 2 + [(None, "no id at all", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS n_words", "'x' AS lang_pred", "2 AS score", "'y' AS __ranges", "3 AS component_id")
    df.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 0, None, None), (1, 1, "assistant", ""), (1, 1, "assistant", "x<\\|y<"), (None, None, "user", "no id"), (2, 0, "a\n\\|", "<|image|>"), (2, 0, "a\n\\|", "<|image|>")], CHAT).withColumn("parts", F.lit(1)).write.parquet(f"{d}/conversations.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "same row"), (4, " ".join(map(str, range(30))))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], DOC).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], CHAT).write.parquet(f"{d}/conversations.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d
