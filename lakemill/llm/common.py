"""Plumbing shared by the training-data operators: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handed to a batch function at once; bounds a Python worker's memory.
BATCH_BYTES = 4 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where none is configured, one is made for a local master alone."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lakemill-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it back.

    The shuffle files of the query that wrote it are removed as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete what ``materialize`` wrote; nothing that is still to run may read it."""
    for df in written:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, rid: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a row id that is never null, and one row for each row id.

    Row ids go up with the doc_id, nulls first, and then with a hash of the text; rows equal in doc_id and text share one.
    They are the doc_ids themselves where those are unique and not null.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if not ids.where("n > 1 or doc_id is null").limit(1).count():
        docs = docs.withColumn(rid, F.col("doc_id"))
        return docs, docs
    h, d, g = (fresh(docs, x) for x in ("hash_of_text", "id_of_key", "hash_of_key"))
    docs = docs.withColumn(h, F.xxhash64(F.coalesce("text", F.lit(""))))
    keys = docs.select("doc_id", h).distinct().repartitionByRange("doc_id", h).sortWithinPartitions("doc_id", h)
    # ids go up with the partition, and within it with the row
    keys = materialize(keys.withColumn(rid, F.monotonically_increasing_id()), "keys").toDF(d, g, rid)
    docs = docs.join(keys, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(h) == F.col(g))).drop(d, h, g)
    docs = materialize(docs, "keyed")
    return docs, docs.dropDuplicates([rid])


def slices(batch: pa.RecordBatch, column: str | None, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Split a batch so that ``column`` holds about ``most`` bytes, one row at least."""
    if column is None or batch.num_rows <= 1:
        yield batch
        return
    sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a batch's texts, null as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [t or b"" for t in col.cast(pa.binary() if pa.types.is_string(col.type) else pa.large_binary()).to_pylist()]


def append_columns(df: DataFrame, fields: list[T.StructField], start: Callable, text_col: str = "text") -> DataFrame:
    """Add columns computed by batch. ``start()`` runs once a task and returns ``f(batch) -> list of columns``.

    Input columns that have the name of an added one are replaced.
    """
    new = {f.name.lower() for f in fields}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])
    schema = T.StructType([*df.schema.fields, *fields])
    names = [f.name for f in schema.fields]

    def run(batches):
        f = start()
        for batch in batches:
            for part in slices(batch, text_col):
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([*part.columns, *map(_array, f(part))], names)

    def _array(x):
        return x if isinstance(x, pa.Array) else pa.array(x)

    return df.mapInArrow(run, schema)


def ascii_lower(text: bytes) -> bytes:
    """Lower-case A-Z alone; ``bytes.lower`` leaves all other bytes as they are."""
    return text.lower()
