"""Sessions with the settings that results depend on."""

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """UTC, ANSI arithmetic and adaptive execution; further settings by name with _ for the dots."""
    builder = SparkSession.builder.appName("tidewatt")
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in {**fixed, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
