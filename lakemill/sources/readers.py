"""File formats as DataFrames of strings. Files are only touched through Spark's readers."""

from __future__ import annotations

import csv
import shlex

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.operators import ranks
from lakemill.sources import csv_splits

DELIMITERS = ",\t;|"
#: Keys under which a JSON document may hold its rows.
ROW_KEYS = ("data", "records", "items", "entries", "results")


def head(spark: SparkSession, path: str, lines: int = 50) -> list[str]:
    return [r["value"] for r in spark.read.text(path).limit(lines).collect()]


def sniff_delimiter(spark: SparkSession, path: str, default: str = ",") -> str:
    try:
        return csv.Sniffer().sniff("\n".join(head(spark, path))[:4096], DELIMITERS).delimiter
    except csv.Error:
        return default


def _csv(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    return csv_splits.read_records(spark, path, delimiter or sniff_delimiter(spark, path))


def read_csv(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """All columns as strings, empty fields as empty strings, rows in file order; compression by suffix.

    Quoted line feeds do not make a file one task. ``read_rows`` gives the places of rows instead of a sort by them.
    """
    return _csv(spark, path, delimiter).orderBy("__path", "__row").drop("__path", "__file", "__row")


def _strings(df: DataFrame) -> DataFrame:
    """Scalars as strings, nested values as JSON."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[(F.to_json(f"`{f.name}`") if isinstance(f.dataType, nested) else F.col(f"`{f.name}`").cast("string")).alias(f.name) for f in df.schema.fields])


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One object a line; blank lines are skipped and a malformed line fails the read."""
    return _strings(spark.read.option("mode", "FAILFAST").json(path))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A list of rows, an object that holds one under a known key, an object of objects, or a single row."""
    doc = spark.read.option("multiLine", True).json(path)
    by_name = {f.name: f.dataType for f in doc.schema.fields}
    for key in ROW_KEYS:
        if isinstance(by_name.get(key), T.ArrayType) and isinstance(by_name[key].elementType, T.StructType):
            return _strings(doc.select(F.explode(f"`{key}`").alias("row")).select("row.*"))
    if by_name and all(isinstance(t, T.StructType) for t in by_name.values()):
        whole = spark.read.text(path, wholetext=True)
        fields = {f.name: f.dataType for t in by_name.values() for f in t.fields}
        row = T.StructType([T.StructField(n, t) for n, t in fields.items()])
        rows = whole.select(F.from_json("value", T.MapType(T.StringType(), row)).alias("m")).select(F.explode("m").alias("k", "row"))
        return _strings(rows.select("row.*"))
    return _strings(doc)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = path if isinstance(path, list) else [path]
    return spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)


def positioned(df: DataFrame) -> DataFrame:
    """``df``, as read from files, with __path, __file and __row: the file and the row's number in it, from 1.

    Rows of a split of a file are numbered as they come, and the splits' counts say where each begins; so numbers
    do not depend on how files are split, and no file is one task.
    """
    here = [F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
    rows = df.select("*", *here, F.monotonically_increasing_id().alias("__id"))
    blocks = rows.groupBy(F.col("__path").alias("__p"), F.col("__block").alias("__b")).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__p").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("__p", "__b", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    joined = rows.join(starts, (F.col("__path") == F.col("__p")) & (F.col("__block") == F.col("__b")))
    return joined.withColumn("__row", F.col("__id") + F.col("__shift")).drop("__p", "__b", "__block", "__id", "__shift")


def read_lines(spark: SparkSession, path: str | list[str], skip_comments: bool = True) -> DataFrame:
    """(path, line_number, line): trimmed, blank and comment lines dropped; numbers count every physical line."""
    lines = positioned(spark.read.text(path, lineSep="\n"))
    lines = lines.select(F.col("__path").alias("path"), F.col("__row").alias("line_number"), F.trim(F.regexp_replace("value", r"\r$", "")).alias("line")).where("line <> ''")
    return lines.where(~F.col("line").startswith("#")) if skip_comments else lines


def read_xml(spark: SparkSession, path: str, tag: str = "entry") -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("inferSchema", False).load(path)


def _arff(spark: SparkSession, path: str) -> DataFrame:
    lines = read_lines(spark, path, skip_comments=False).where(~F.col("line").startswith("%"))
    start = lines.where(F.lower("line").startswith("@data")).groupBy("path").agg(F.min("line_number").alias("start"))
    rows = lines.join(start, "path")
    first = start.agg(F.min("path")).first()[0]
    header = rows.where((F.col("path") == first) & (F.col("line_number") < F.col("start")) & F.lower("line").startswith("@attribute"))
    names = [shlex.split(r["line"])[1] for r in header.orderBy("line_number").select("line").collect()]
    if not names:
        raise ValueError("no attributes in the ARFF header")
    data = rows.where(F.col("line_number") > F.col("start"))
    data = data.withColumn("line", F.when(F.col("line").startswith("{"), F.raise_error(F.lit("sparse ARFF rows are not supported"))).otherwise(F.col("line")))
    parsed = F.from_csv("line", ", ".join(f"`{n}` string" for n in names), {"quote": "'", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    numbered = ranks.running(data.withColumn("__one", F.lit(1)), ["path"], F.floor(F.col("line_number") / 100_000), ["line_number"], {"__row": "__one"}, {})
    rows = numbered.select(parsed.alias("r"), F.col("path").alias("__path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("__file"), "__row")
    return rows.select("r.*", "__path", "__file", "__row").na.fill("", names)


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    """Attributes from the header; short rows are filled up with empty strings, sparse rows are refused."""
    return _arff(spark, path).drop("__path", "__file", "__row")


def read_raw_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, stem, suffix, value): a row per file, read whole."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = files.select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.select("path", F.regexp_replace("path", r"\.[^./]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("suffix"), "value")


READERS = {"csv": read_csv, "tsv": lambda s, p: read_csv(s, p, "\t"), "jsonl": read_jsonl, "json": read_json, "parquet": read_parquet, "xml": read_xml, "arff": read_arff}


#: Formats of which many files are one read; of the others each file has its own header or shape.
TOGETHER = ("parquet", "jsonl", "txt")


def suffix_of(path: str | list[str]) -> str:
    if isinstance(path, list):
        path = path[0]
    parts = path.rstrip("/").rsplit("/", 1)[-1].lower().split(".")
    return parts[-2] if len(parts) > 2 and parts[-1] in ("gz", "bz2") else parts[-1]


def _reader(path: str | list[str]):
    suffix = suffix_of(path)
    if suffix not in READERS:
        raise ValueError(f"unsupported format {suffix!r}")
    return READERS[suffix]


def read_any(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """By suffix, compression aside."""
    return _reader(path)(spark, path)


def read_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As ``read_any``, with each row's place: __path, __file, __row."""
    own = {"arff": _arff, "csv": _csv, "tsv": lambda s, p: _csv(s, p, "\t")}
    if (suffix := suffix_of(path)) in own:
        return own[suffix](spark, path)
    return positioned(_reader(path)(spark, path))


def list_snapshot(spark: SparkSession, root: str, pattern: str = "*") -> list[str]:
    """Sorted paths of a folder's files, which defines the order of rows; folders are compared name by name."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path").collect()
    return sorted((r["path"] for r in rows), key=lambda p: p.split("/"))


def snapshot_reads(spark: SparkSession, path: str) -> list[str | list[str]]:
    """What to read of a snapshot: the file itself, or a folder's files of known formats, together where they can be."""
    if suffix_of(path) in (*READERS, "txt"):
        return [path]
    reads, together = [], {}
    for p in list_snapshot(spark, path):
        suffix = suffix_of(p)
        if suffix in TOGETHER:
            together.setdefault(suffix, []).append(p)
        elif suffix in READERS:
            reads.append(p)
    return reads + list(together.values())
