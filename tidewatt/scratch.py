"""Tables that a query writes on its way, in a folder that every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the session's ``spark.checkpoint.dir``; only where that is unset and Spark
    runs on one machine, as in tests, below a temporary folder."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
        folder = tempfile.mkdtemp(prefix="scratch-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return f"{folder}/{name}-{uuid.uuid4().hex}"
