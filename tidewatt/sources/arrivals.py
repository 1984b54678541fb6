"""Files that are read once: a ledger of path, time and size against what is there.

A file whose path the ledger lacks, or whose time or size differ from its last entry, is read; entries are
appended when its rows are safe. So a run that fails reads the same files again, and one that finds
nothing new reads no file's content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.operators import upsert
from tidewatt.sources.archives import files
from tidewatt.sources.documents import file_day

LEDGER = "path string, modified timestamp, size long, run long"


def unread(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files whose last entry, the one of the newest run, is not of their time and size."""
    last = ledger.groupBy("path").agg(F.max_by(F.struct("modified", "size"), "run").alias("_e"))
    return found.join(last.select("path", "_e.modified", "_e.size"), ["path", "modified", "size"], "left_anti")


def entries(read: DataFrame, run: int) -> DataFrame:
    return read.select("path", "modified", "size", F.lit(run).cast("long").alias("run"))


def latest_day(ledger: DataFrame, day: Column | None = None) -> DataFrame:
    """The high-water mark: the newest date in a file name, in one row; null without any."""
    return ledger.agg(F.max(file_day(F.col("path")) if day is None else day).alias("latest"))


def ledger_at(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty where there is none yet."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    there = root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def take_in(spark: SparkSession, source: str, table: str, ledger: str, read, run: int, pattern: str = "*") -> int:
    """One run: read(files) turns new and changed files (path, modified, size, content) into rows, with the
    column path, which replace the rows that the table at ``table`` has of those files; then the files are
    entered. Returns how many were read. The files read are fixed in the ledger's staging first, so what is entered is
    what was read, whatever arrives meanwhile."""
    found = unread(files(spark, source, pattern).drop("content"), ledger_at(spark, ledger))
    found.write.mode("overwrite").parquet(f"{ledger}__run")
    mine = spark.read.schema(found.schema).parquet(f"{ledger}__run")
    count = mine.count()
    if not count:
        return 0
    content = files(spark, source, pattern).join(F.broadcast(mine) if count <= 10_000 else mine, ["path", "modified", "size"], "left_semi")
    rows = read(content)
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(table)
    old = spark.read.schema(rows.schema).parquet(table) if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) else rows.limit(0)
    kept = old.join(mine.select("path"), "path", "left_anti")
    upsert.swap_in(kept.unionByName(rows), table)
    entries(mine, run).write.mode("append").parquet(ledger)
    return count
