"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder. Where none is configured, one is made for a local master alone."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lakemill-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again, which cuts the lineage."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.written_to = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete what ``cut`` wrote; nothing that is still to run may read it."""
    for df in written:
        remove(df.sparkSession, df.written_to)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
