"""Down-sampling behind completeness gates, up-sampling, and minute features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions import stats
from tidewatt.functions import timegrid as T

Rule = tuple[str, ...]


def aggregates(rules: dict[str, Rule], order: list[str], scale: dict[str, str] | None = None) -> list[Column]:
    """Output name -> (rule, column, ...). Rules: mean, median, sum, min, max, last (by ``order``),
    any, count, vwap (price, volume), hour (that the first one is in). scale: decimal types that outputs are cast to."""
    made = {
        "mean": F.avg, "median": stats.median, "sum": F.sum, "min": F.min, "max": F.max, "any": F.max, "count": F.count,
        "last": lambda c: stats.last_by(c, *order), "vwap": stats.vwap, "hour": lambda c: F.date_trunc("hour", F.min(c)),
    }
    out = []
    for name, (rule, *columns) in rules.items():
        c = made[rule](*columns)
        out.append((c.cast(scale[name]) if scale and name in scale else c).alias(name))
    return out


def downsample(df: DataFrame, ts: str, rules: dict[str, Rule], keys: list[str] = [], minutes: int = 15, order: list[str] | None = None, scale: dict[str, str] | None = None) -> DataFrame:
    """keys, trade_date, time_interval and the aggregates of each bucket; one shuffle, on a
    partial aggregate."""
    start = T.floor_to(F.col(ts), minutes)
    rows = df.withColumn("_start", start)
    out = rows.groupBy(*keys, "_start").agg(*aggregates(rules, order or [ts], scale))
    return out.select(*keys, F.to_date("_start").alias("trade_date"), T.label(F.col("_start"), minutes).alias("time_interval"), *rules)


def roll_up(df: DataFrame, rules: dict[str, Rule], keys: list[str] = [], gate: int | None = 4, interval: str = "time_interval", scale: dict[str, str] | None = None) -> DataFrame:
    """Hours of quarters. gate: distinct quarters that an hour must have to be there."""
    rows = df.withColumn("_hour", T.hour_label(F.col(interval)))
    out = rows.groupBy(*keys, "trade_date", "_hour").agg(*aggregates(rules, [interval], scale), F.count_distinct(interval).alias("_n"))
    if gate:
        out = out.where(F.col("_n") == gate)
    return out.select(*keys, "trade_date", F.col("_hour").alias("time_interval"), *rules)


def incomplete_hours(df: DataFrame, keys: list[str] = [], gate: int = 4) -> DataFrame:
    """keys, trade_date and hour of hours with fewer distinct quarters than the gate."""
    rows = df.withColumn("hour_interval", T.hour_label(F.col("time_interval")))
    return rows.groupBy(*keys, "trade_date", "hour_interval").agg(F.count_distinct("time_interval").alias("quarters")).where(F.col("quarters") < gate)


def upsample(df: DataFrame, hour: str, shared: list[str] = [], copied: list[str] = []) -> DataFrame:
    """Four quarters of each hourly row: shared columns are divided by 4, copied ones repeated."""
    rows = df.withColumn("quarter", F.explode(F.sequence(F.lit(0), F.lit(3))))
    start = F.col(hour) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("quarter") * 15)
    rest = [c for c in df.columns if c not in {hour, *shared, *copied}]
    return rows.select(*rest, start.alias(hour), *[(F.col(c) / 4).alias(c) for c in shared], *copied)


def hour_mean_back(df: DataFrame, value: str, keys: list[str], where: Column | None = None) -> DataFrame:
    """Adds <value>_hour, the mean of each row's hour, where the condition holds; else the value."""
    mean = F.avg(value).over(Window.partitionBy(*keys))
    return df.withColumn(f"{value}_hour", mean if where is None else F.when(where, mean).otherwise(F.col(value)))


def touched_intervals(df: DataFrame, ts: str, minutes: int = 15) -> DataFrame:
    """trade_date and time_interval of the buckets that rows fall in, for recomputing only those."""
    start = T.floor_to(F.col(ts), minutes)
    return df.select(F.to_date(start).alias("trade_date"), T.label(start, minutes).alias("time_interval")).distinct()


def trailing_placeholder(df: DataFrame, value: str, day: str, order: list[str]) -> DataFrame:
    """A 0 in the last row of a day is a placeholder, and becomes null."""
    last = F.row_number().over(Window.partitionBy(day).orderBy(*[F.desc(c) for c in order])) == 1
    return df.withColumn("_last", last).withColumn(value, F.when(F.col("_last") & (F.col(value) == 0), None).otherwise(F.col(value))).drop("_last")


def moments(x: str, prefix: str) -> list[Column]:
    """min, max, range, standard deviation and skewness of a column."""
    return [F.min(x).alias(f"{prefix}_min"), F.max(x).alias(f"{prefix}_max"), (F.max(x) - F.min(x)).alias(f"{prefix}_range"), F.stddev_samp(x).alias(f"{prefix}_std"), stats.skew(x).alias(f"{prefix}_skew")]


def gated(df: DataFrame, count: str, least: int, columns: list[str]) -> DataFrame:
    """Columns are null where too few rows were counted."""
    return df.withColumns({c: F.when(F.col(count) >= least, F.col(c)) for c in columns})


def saturation(df: DataFrame, value: str, day: str, q: float = 0.95, share: float = 0.95) -> DataFrame:
    """Adds saturated: whether |value| is at least ``share`` of its day's q-quantile of |value|.
    One row a day is joined back."""
    limits = df.groupBy(F.col(day).alias("_day")).agg(stats.quantile(F.abs(value), q).alias("_limit"))
    joined = df.join(limits, F.col(day) == F.col("_day"), "left")
    flag = F.abs(value) >= F.coalesce("_limit", F.lit(999999.0)) * share
    return joined.withColumn("saturated", F.coalesce(flag, F.lit(False))).drop("_day", "_limit")


def rolling(df: DataFrame, value: str, order: list[str], frames: dict[str, tuple[str, int]], keys: list[str] = []) -> DataFrame:
    """frames: output -> (mean or sum, rows before the current one). Frames count rows, whatever
    the gaps. Without keys give a coarse one, else all rows pass one task: see rolling_blocks."""
    functions = {"mean": F.avg, "sum": F.sum}
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({name: functions[f](value).over(w.rowsBetween(-n, 0)) for name, (f, n) in frames.items()})


def rolling_blocks(df: DataFrame, value: str, day: str, order: list[str], frames: dict[str, tuple[str, int]], block_days: int = 28) -> DataFrame:
    """As :func:`rolling` over all rows without a key, in blocks of days that run in parallel. Each
    block also gets as many of the rows before it as the longest frame reaches back; a block that
    holds fewer than that is reached over by numbering rows block by block first."""
    most = max(n for _, n in frames.values())
    block = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / block_days).cast("long")
    rows = df.withColumn("_block", block)
    within = Window.partitionBy("_block").orderBy(*order)
    counts = rows.groupBy("_block").agg(F.count("*").alias("_n"))
    before = counts.select("_block", (F.sum("_n").over(Window.orderBy("_block")) - F.col("_n")).alias("_before"))
    numbered = rows.withColumn("_k", F.row_number().over(within)).join(before, "_block").withColumn("_k", F.col("_k") + F.col("_before") - 1)
    size = max(most + 1, 4096)
    home = F.floor(F.col("_k") / size)
    spread = numbered.withColumn("_home", home).withColumn("_part", F.explode(F.when(F.col("_k") % size >= size - most, F.array(home, home + 1)).otherwise(F.array(home))))
    functions = {"mean": F.avg, "sum": F.sum}
    w = Window.partitionBy("_part").orderBy("_k")
    out = spread.withColumns({name: functions[f](value).over(w.rowsBetween(-n, 0)) for name, (f, n) in frames.items()})
    return out.where("_part = _home").select(*df.columns, *frames)
