"""The package for Python workers that don't have it on their path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

NAME = "tidewatt_llm_workers.zip"
#: Rows in an Arrow batch, unless the session says otherwise: whole texts are long, and a worker holds a batch of them at a time.
BATCH = 1024
_KEY, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Hands this subpackage's modules to the workers, once for each Spark context, in batches of texts that fit them."""
    context = spark.sparkContext
    if spark.conf.get(_KEY, _DEFAULT) == _DEFAULT:
        spark.conf.set(_KEY, str(BATCH))
    if NAME in context._python_includes:
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp()) / NAME
    with zipfile.ZipFile(path, "w") as z:
        for f in [root / "__init__.py", *sorted((root / "llm").glob("*.py"))]:
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(path))
