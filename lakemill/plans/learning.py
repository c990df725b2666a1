"""Model queries. Coefficients depend on the solver, so they have no SQL; tests hold their metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.urls import with_url
from lakemill.operators import models, splits
from lakemill.operators.storage import cut
from lakemill.plans.catalogue import table
from lakemill.plans.samples import odd_pages

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _fit(df: DataFrame, featurizer: models.Featurizer, estimator: str, terms: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Train on the train split and predict all rows; ``terms`` come after the split, which would shuffle and sort them."""
    rows = cut(terms(splits.stratified(df, "sample_id", "label")), "learning")
    bundle = models.train(rows.where("split = 'train'"), featurizer, estimator)
    return bundle.predict(rows.withColumn("label", F.col("label").cast("double"))).select("sample_id", "split", F.col("label").cast("int").alias("label"), "predicted", "score", "score_prob")


def _texts(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    return rows.select(F.col("doc_id").alias("sample_id"), F.col("toxic").alias("label"), "text")


def _urls(spark, d):
    """Whether a page asks for a password, from its URL alone."""
    rows = with_url(odd_pages(table(spark, d, "pages")), "url").select(F.col("page_id").alias("sample_id"), "normalized_url", F.lower("html").rlike("type=[\"']?password").cast("int").alias("label"))
    return models.url_terms(rows.where("label is not null"))


@query
def ml_url_tfidf_logreg(spark, d):
    return _fit(_urls(spark, d), models.Featurizer("tfidf"), "logistic_regression")


@query
def ml_text_tfidf_svm(spark, d):
    return _fit(_texts(spark, d), models.Featurizer("tfidf", 250_000), "linear_svm", lambda rows: models.text_terms(rows, "text").drop("text"))


NUMBERS = ["chars", "lines", "symbols", "digits", "capitals", "mean_word"]


def _parts(spark, d):
    """Quality of documents from counts and the source; the label is no feature, nor made from one."""
    text, n = F.coalesce("text", F.lit("")), F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1))
    share = lambda pattern: F.length(F.regexp_replace(text, pattern, "")) / n
    numbers = [F.log1p(F.length(text)), F.log1p(F.size(F.split(text, "\n"))), share("[\\p{L}\\p{N}\\s]"), share("[^0-9]"), share("[^A-Z]"), n / F.size(F.split(text, "\\s+"))]
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    rows = rows.select(F.col("doc_id").alias("sample_id"), F.col("quality").alias("label"), F.create_map(F.lit("lang"), F.coalesce("lang", F.lit(""))).alias("m"), *[x.cast("double").alias(c) for x, c in zip(numbers, NUMBERS)])
    return rows.withColumn("terms", models.map_terms(F.col("m")))


@query
def ml_tabular_forest(spark, d):
    return _fit(_parts(spark, d), models.Featurizer("terms", numeric=NUMBERS), "random_forest")


@query
def ml_tabular_boosting(spark, d):
    return _fit(_parts(spark, d), models.Featurizer("terms", numeric=NUMBERS), "gradient_boosting")


@query
def ml_embedding_logreg(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample_id"), (F.col("label") % 2).alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("vector"))
    return _fit(rows, models.Featurizer("vector"), "logistic_regression")
