"""Vectors from dictionaries of mixed values: numbers and booleans as they are, strings one-hot.

A feature of a number or boolean has its key's name, one of a string is named ``key=value``. Names are sorted, and
what a row lacks is zero. Keys may hold numbers in some rows and strings in others. Everything stays in the JVM:
a SQL stage for the numbers, a vocabulary for the strings, and a slicer that puts both in the order of names.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct names that may reach the driver; more is an error, not a cut.
MOST_NAMES = 1_000_000

_ENTRY = "struct<name:string,number:double,term:string>"


def _of_struct(c: Column, fields: list[T.StructField]) -> Column:
    made = []
    for f in fields:
        v = c[f.name]
        if isinstance(f.dataType, T.StringType):
            entry = F.struct(F.lit(f.name).alias("name"), F.lit(None).cast("double").alias("number"), F.concat(F.lit(f"{f.name}="), v).alias("term"))
        elif isinstance(f.dataType, (T.BooleanType, T.NumericType)):
            entry = F.struct(F.lit(f.name).alias("name"), v.cast("double").alias("number"), F.lit(None).cast("string").alias("term"))
        else:
            raise TypeError(f"{f.name} is no number, boolean or string: {f.dataType.simpleString()}")
        made.append(F.when(v.isNotNull(), entry.cast(_ENTRY)))
    return F.array_compact(F.array(*made)) if made else F.array().cast(f"array<{_ENTRY}>")


def _of_map(c: Column, value: T.DataType) -> Column:
    def entry(e):
        k, v = e["key"], e["value"]
        if isinstance(value, T.VariantType):
            kind = F.schema_of_variant(v)
            string = kind == "STRING"
            number = F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double")).otherwise(F.try_variant_get(v, "$", "double"))
            term = F.when(string, F.concat(k, F.lit("="), F.try_variant_get(v, "$", "string")))
            return F.struct(k.alias("name"), F.when(~string, number).alias("number"), term.alias("term"))
        if isinstance(value, T.StringType):
            return F.struct(k.alias("name"), F.lit(None).cast("double").alias("number"), F.concat(k, F.lit("="), v).alias("term"))
        return F.struct(k.alias("name"), v.cast("double").alias("number"), F.lit(None).cast("string").alias("term"))

    if not isinstance(value, (T.VariantType, T.StringType, T.BooleanType, T.NumericType)):
        raise TypeError(f"map values are no numbers, booleans or strings: {value.simpleString()}")
    made = F.transform(F.map_entries(c), lambda e: entry(e).cast(_ENTRY))
    return F.filter(made, lambda e: e["number"].isNotNull() | e["term"].isNotNull())


def entries(df: DataFrame, column: str) -> Column:
    """array<struct<name, number, term>> of a struct, a map, or a VARIANT object; of its nulls nothing is left."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StructType):
        made = _of_struct(c, kind.fields)
    elif isinstance(kind, T.VariantType):
        made = _of_map(c.cast("map<string,variant>"), T.VariantType())
    elif isinstance(kind, T.MapType):
        made = _of_map(c, kind.valueType)
    else:
        raise TypeError(f"{column} is no dictionary: {kind.simpleString()}")
    return F.coalesce(F.when(c.isNotNull(), made), F.array().cast(f"array<{_ENTRY}>"))


def dictionary_terms(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``numbers`` (map of names) and ``terms`` (one-hot names), which ``fit`` and its model read.

    Of a key that a map has twice the last value counts.
    """
    df = df.withColumn("__entries", entries(df, column))
    numbers = F.filter("__entries", lambda e: e["number"].isNotNull())
    last = F.aggregate(numbers, F.expr("cast(map() as map<string,double>)"), lambda have, e: F.map_concat(F.map_filter(have, lambda k, _: k != e["name"]), F.create_map(e["name"], e["number"])))
    terms = F.transform(F.filter("__entries", lambda e: e["term"].isNotNull()), lambda e: e["term"])
    return df.withColumns({"numbers": last, "terms": terms}).drop("__entries")


def vocabulary(df: DataFrame, most: int = MOST_NAMES) -> tuple[list[str], list[str]]:
    """(names of numbers, one-hot names) of rows from ``dictionary_terms``, each sorted."""
    names = df.select(F.explode(F.concat(F.transform(F.map_keys("numbers"), lambda k: F.struct(F.lit(0).alias("kind"), k.alias("name"))), F.transform("terms", lambda t: F.struct(F.lit(1).alias("kind"), t.alias("name"))))).alias("x"))
    found = names.select("x.*").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} feature names")
    return tuple(sorted(r["name"] for r in found if r["kind"] == k) for k in (0, 1))


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit(df: DataFrame, out: str = "features", most: int = MOST_NAMES) -> tuple[PipelineModel, list[str]]:
    """The vectorising pipeline and its feature names, in order, from rows of ``dictionary_terms``."""
    numbers, terms = vocabulary(df, most)
    stages, inputs = [], []
    if numbers:
        own = [f"__number_{k}" for k in range(len(numbers))]
        columns = ", ".join(f"coalesce(try_element_at(numbers, {_quoted(n)}), 0D) AS {c}" for n, c in zip(numbers, own))
        stages.append(SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"))
        inputs += own
    if terms:
        stages.append(CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="__terms"))
        stages[-1].setBinary(True)
        inputs.append("__terms")
    names = numbers + terms
    order = sorted(range(len(names)), key=lambda k: names[k])
    if not names:
        raise ValueError("no features")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="__unordered"))
    stages.append(VectorSlicer(inputCol="__unordered", outputCol=out, indices=order))
    return PipelineModel(stages), [names[k] for k in order]


def long_form(vectors: DataFrame, key: str, names: list[str], column: str = "features") -> DataFrame:
    """(key, position, feature, value) of the entries that are not zero."""
    spark: SparkSession = vectors.sparkSession
    at = vectors.select(key, F.posexplode(vector_to_array(column)).alias("position", "value")).where("value <> 0")
    listed = spark.createDataFrame(list(enumerate(names)), "position int, feature string")
    return at.join(listed, "position").select(key, "position", "feature", "value")
