"""Data-quality queries: gaps, islands, coverage, null counts and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions.timegrid import clock_seconds, spine


def missing_dates(df: DataFrame, day: str) -> DataFrame:
    """Dates between the first and the last that have no row."""
    present = df.select(F.to_date(day).alias("day")).where("day is not null").distinct()
    every = present.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null").select(spine(F.col("a"), F.col("b"), "1 day").alias("day"))
    return every.join(present, "day", "left_anti")


def islands(df: DataFrame, at: str, unit_seconds: int) -> DataFrame:
    """first, last, n of runs of consecutive instants. The runs are found per day, joined over
    midnight within decades, and over the ends of decades, so tasks see a day's points, a decade's
    runs, or two runs of each decade."""
    step = lambda c: clock_seconds(c) / unit_seconds
    points = df.select(F.floor(step(F.col(at))).cast("long").alias("k")).where("k is not null").distinct()
    per_day = max(1, 86400 // unit_seconds)
    numbered = points.withColumn("d", F.floor(F.col("k") / per_day)).withColumn("g", F.col("k") - F.row_number().over(Window.partitionBy("d").orderBy("k")))
    runs = numbered.groupBy("d", "g").agg(F.min("k").alias("a"), F.max("k").alias("b"))
    w = Window.partitionBy(F.floor(F.col("d") / 3650)).orderBy("a")
    opens = runs.withColumn("o", F.when(F.col("a") == F.lag("b").over(w) + 1, 0).otherwise(1)).withColumn("r", F.sum("o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = opens.groupBy(F.floor(F.col("d") / 3650).alias("e"), "r").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    # Only the first and last run of a decade can go on in the next one.
    own = Window.partitionBy("e")
    joined = joined.withColumn("edge", (F.col("a") == F.min("a").over(own)) | (F.col("a") == F.max("a").over(own)))
    every = Window.partitionBy().orderBy("a")
    ends = joined.where("edge").select("a", "b").withColumn("o", F.when(F.col("a") == F.lag("b").over(every) + 1, 0).otherwise(1)).withColumn("r", F.sum("o").over(every.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.where("not edge").select("a", "b").unionByName(ends.groupBy("r").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("r"))
    day = lambda c: F.floor(c * unit_seconds / 86400).cast("int")
    back = lambda c: F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(day(c), F.lit(0), F.lit(0), F.pmod(c * unit_seconds, F.lit(86400)))
    return whole.select(back(F.col("a")).alias("first"), back(F.col("b")).alias("last"), (F.col("b") - F.col("a") + 1).alias("n"))


def missing_points(df: DataFrame, day: str, position: str, positions: int) -> DataFrame:
    """Positions 0 to positions-1 that days lack."""
    days = df.select(day).distinct()
    grid = days.withColumn(position, F.explode(F.sequence(F.lit(0), F.lit(positions - 1))))
    return grid.join(df.select(day, position).distinct(), [day, position], "left_anti")


def coverage(df: DataFrame, day: str, per_day: int) -> DataFrame:
    """first_day, last_day, actual, expected, percent."""
    found = df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("actual"))
    expected = ((F.datediff("last_day", "first_day") + 1) * per_day).cast("long")
    return found.select("first_day", "last_day", "actual", expected.alias("expected"), F.round(100.0 * F.col("actual") / expected, 2).alias("percent"))


def without_data(wanted: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Those that the table has no row for, such as areas and days still to be fetched."""
    return wanted.join(table.select(*keys), keys, "left_anti")


def unanswered(requests: DataFrame, log: DataFrame, field: str, now: Column, hours: int = 24) -> DataFrame:
    """Requests that no log row of the last hours with status 200 names in its response_body's field."""
    done = log.where((F.col("response_status") == 200) & (F.col("created_at") > now - F.make_dt_interval(F.lit(0), F.lit(hours))))
    return requests.join(done.select(F.get_json_object("response_body", f"$.{field}").alias(field)), field, "left_anti")


def status(percent: Column) -> Column:
    return F.when(percent.isNull() | (percent == 0), "EMPTY").when(percent >= 99, "OK").when(percent >= 90, "WARN").otherwise("GAPS")


def null_counts(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """table_name, column_name, rows, nulls of each listed column; one scan of each table."""
    out = None
    for name, df in tables.items():
        counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns[name]])
        part = counts.select(F.lit(name).alias("table_name"), F.col("_n").alias("rows"), F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns[name]])).alias("_c"))
        part = part.select("table_name", "_c.column_name", "rows", "_c.nulls")
        out = part if out is None else out.unionByName(part)
    return out


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], a_value: str, b_value: str) -> DataFrame:
    """keys, both values, and which side has the key: both, left or right."""
    x, y = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    side = F.when(F.col("_a") & F.col("_b"), "both").when(F.col("_a"), "left").otherwise("right")
    return x.join(y, keys, "full_outer").select(*keys, a_value, b_value, side.alias("side"))
