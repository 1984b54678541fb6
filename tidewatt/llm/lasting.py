"""Cutting lineage in a place that every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the session's ``spark.checkpoint.dir``; only where that is unset and
    Spark runs on one machine, as in tests, a temporary one is made."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def lasting(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same rows as Parquet in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.written_at = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes the table of :func:`written`, which nothing may read any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.written_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
