"""Features and classifiers with Spark ML: TF-IDF over characters or words, tabular features, embeddings."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.text import word_grams
from lakemill.functions.urls import model_features, with_url
from lakemill.operators import metrics, vectorizer
from lakemill.operators.boosting import Boosting
from lakemill.operators.linear_svm import SquaredHingeSVM
from lakemill.operators.trees import Forest

SEED = 42


def word_border_grams(c: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Character n-grams inside words padded by a space on both sides; a shorter word counts once per size."""
    words = F.transform(F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of(n: int) -> Column:
        return F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - (n - 1), F.lit(1))), lambda i: F.substring(w, i, F.lit(n)))))

    return F.flatten(F.array(*[of(n) for n in sizes]))


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def map_terms(c: Column) -> Column:
    """String features as one-hot terms ``k=v``."""
    return F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))


def counted_terms(df: DataFrame, most: int, min_df: float) -> tuple[CountVectorizerModel, list[float]]:
    """MLlib's vectorizer of ``terms`` and each term's smoothed inverse document frequency, from one pass.

    The vocabulary is CountVectorizer's, the ``most`` most frequent terms of ``min_df`` documents; of equally frequent ones the first by name.
    """
    n = df.count()
    once = F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df")))
    each = F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df")))
    counts = df.select(F.explode(F.concat(once, each)).alias("x")).groupBy("x.term").agg(F.sum("x.tf").alias("tf"), F.sum("x.df").alias("df"))
    chosen = counts.where(F.col("df") >= (min_df if min_df >= 1 else min_df * n)).orderBy(F.desc("tf"), "term").limit(most).cache()
    try:
        ordered, jvm = chosen.orderBy(F.desc("tf"), "term"), df.sparkSession.sparkContext._jvm
        # the names stay in the JVM; one by one they would take longer than the count
        names = getattr(ordered.select("term")._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING()).collect()
        model = CountVectorizerModel(jvm.org.apache.spark.ml.feature.CountVectorizerModel(names))
        return model.setInputCol("terms").setOutputCol("tf"), [math.log((n + 1) / (r["df"] + 1)) + 1 for r in ordered.select("df").collect()]
    finally:
        chosen.unpersist()


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``df`` with weight n / (2 n_c), from one small aggregate."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    pairs = [F.lit(x) for k, n in counts.items() for x in (int(k), total / (2.0 * n))]
    return df.withColumn("weight", F.element_at(F.create_map(*pairs), F.col(label).cast("int")))


#: Sizes of the reference; a forest's depth is unlimited there, and MLlib stops at 30.
ESTIMATORS = {
    "logistic_regression": lambda n: LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=1.0 / max(n, 1), standardization=False, maxIter=3000),
    "linear_svm": lambda n: SquaredHingeSVM(C=1.0, maxIter=1000),
    "random_forest": lambda n: Forest(numTrees=400, maxDepth=30, seed=SEED),
    "url_forest": lambda n: Forest(numTrees=300, maxDepth=30, seed=SEED),
    "gradient_boosting": lambda n: Boosting(maxIter=300, stepSize=0.05, maxDepth=6, seed=SEED),
}


@dataclass
class Featurizer:
    """Turns ``terms`` (array<string>), ``numbers`` and ``terms``, or ``vector`` into ``features``; fitted on the training rows."""

    kind: str  # "tfidf", "terms", "dictionary" or "vector"
    vocabulary: int = 200_000
    min_df: float = 2.0
    numeric: list[str] = field(default_factory=list)
    model: PipelineModel | None = None
    names: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame) -> Featurizer:
        if self.kind == "dictionary":
            self.model, self.names = vectorizer.fit(df)
            return self
        if self.kind == "vector":
            stages = []
        else:
            if self.kind == "tfidf":
                counts, idf = counted_terms(df, self.vocabulary, self.min_df)
                stages = [counts, ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="scaled"), Normalizer(p=2.0, inputCol="scaled", outputCol="text_vector")]
            else:
                stages = [CountVectorizer(inputCol="terms", outputCol="tf", minDF=1.0, vocabSize=self.vocabulary, binary=True).fit(df)]
        inputs = {"vector": ["vector"], "terms": ["tf"], "tfidf": ["text_vector"]}[self.kind] + self.numeric
        if inputs == ["text_vector"]:  # the assembler would name each of its 200,000 entries in the column's metadata
            stages[-1].setOutputCol("features")
        else:
            stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
        self.model = Pipeline(stages=stages).fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


@dataclass
class Bundle:
    featurizer: Featurizer
    classifier: object

    def predict(self, df: DataFrame) -> DataFrame:
        """sample_id, label, predicted, score, score_prob; an SVM's score is its margin."""
        out = self.classifier.transform(self.featurizer.transform(df))
        raw = vector_to_array("rawPrediction")[1]
        score = vector_to_array("probability")[1] if "probability" in out.columns else raw
        prob = score if "probability" in out.columns else 1 / (1 + F.exp(-raw))
        carry = [c for c in ("split", "source_dataset") if c in out.columns]
        return out.select("sample_id", "label", F.col("prediction").cast("int").alias("predicted"), score.alias("score"), prob.alias("score_prob"), *carry)

    def save(self, path: str) -> None:
        self.featurizer.model.write().overwrite().save(f"{path}/features")
        PipelineModel([self.classifier]).write().overwrite().save(f"{path}/classifier")

    @classmethod
    def load(cls, path: str, kind: str) -> Bundle:
        """What ``save`` wrote; ``kind`` is the featurizer's."""
        return cls(Featurizer(kind, model=PipelineModel.load(f"{path}/features")), PipelineModel.load(f"{path}/classifier").stages[0])


def train(df: DataFrame, featurizer: Featurizer, estimator: str) -> Bundle:
    """Fit on rows with label 0 or 1; raises if there are none."""
    rows = df.where(F.col("label").isin(0, 1)).withColumn("label", F.col("label").cast("double"))
    n = rows.count()
    if not n:
        raise RuntimeError("no supervised rows")
    rows = class_weights(rows)
    featurizer.fit(rows)
    ready = featurizer.transform(rows).select("features", "label", "weight").cache()
    try:
        return Bundle(featurizer, ESTIMATORS[estimator](n).fit(ready))
    finally:
        ready.unpersist()


def evaluate(bundle: Bundle, df: DataFrame, by: str = "split") -> DataFrame:
    """Metrics per split."""
    out = bundle.predict(df)
    return metrics.confusion(out, [by]).join(metrics.curve_areas(out, [by]), by, "left")


def url_terms(df: DataFrame, url: str = "normalized_url") -> DataFrame:
    return df.withColumn("terms", word_border_grams(F.col(url)))


def text_terms(df: DataFrame, text: str = "normalized_text") -> DataFrame:
    return df.withColumn("__words", words(F.col(text))).withColumn("terms", word_grams(F.col("__words"))).drop("__words")


def tabular_terms(df: DataFrame, column: str = "tabular_features") -> DataFrame:
    """Of a map, a struct or a VARIANT object of features."""
    return vectorizer.dictionary_terms(df, column)


def url_feature_terms(df: DataFrame, column: str = "url_features") -> DataFrame:
    """The features of a URL that models learn from; ``column`` names the struct of all of them, made here if missing."""
    if column not in df.columns:
        df = with_url(df, "normalized_url" if "normalized_url" in df.columns else "url")
    return vectorizer.dictionary_terms(df.withColumn("__selected", model_features(column)), "__selected").drop("__selected")


def embedding_vector(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Mean-pooled encoder states, precomputed; any encoder that yields arrays fits."""
    return df.withColumn("vector", array_to_vector(F.col(column).cast("array<double>")))


def predict_one(bundle: Bundle, spark, sample: dict, terms=lambda df: df) -> dict:
    """Score a single sample given the columns its featurizer needs; the echo is cut to 100 characters."""
    df = spark.createDataFrame([sample | {"sample_id": "one", "label": 0.0}])
    row = bundle.predict(terms(df)).first()
    return {"score": round(row["score_prob"], 6), "predicted": row["predicted"], "input": {k: str(v)[:100] for k, v in sample.items()}}
