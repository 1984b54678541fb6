"""From documents' points to the grid, and from long to wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_forward(points: DataFrame, series: list[str], position: str, length: str, values: list[str], initial: float | None = 0.0) -> DataFrame:
    """Every position from 1 to ``length`` of each series; positions that are left out repeat the
    one before, and before the first have the initial value."""
    grid = points.groupBy(*series).agg(F.max(length).alias("_n")).select(*series, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias(position))
    joined = grid.join(points.select(*series, F.col(position).cast("int").alias(position), *values), [*series, position], "left")
    w = Window.partitionBy(*series).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    filled = {v: F.last(v, ignorenulls=True).over(w) for v in values}
    return joined.withColumns({v: c if initial is None else F.coalesce(c, F.lit(initial)) for v, c in filled.items()})


def point_time(start: Column, position: Column, minutes: Column) -> Column:
    """Start of a point: its series' start and as many steps as its position has before it."""
    return start + F.make_dt_interval(F.lit(0), F.lit(0), ((position - 1) * minutes).cast("int"))


def densify(df: DataFrame, keys: list[str], values: list[str], period: str = "period", periods: int = 96, missing: float = 0.0) -> DataFrame:
    """Every period of each key; periods without a row are zero, present rows keep their nulls."""
    grid = df.select(*keys).distinct().withColumn(period, F.explode(F.sequence(F.lit(1), F.lit(periods))))
    rows = df.select(*keys, period, *values).withColumn("_there", F.lit(True))
    out = grid.join(rows, [*keys, period], "left")
    return out.select(*keys, period, *[F.when(F.col("_there"), F.col(v)).otherwise(F.lit(missing)).alias(v) for v in values])


def finest(df: DataFrame, keys: list[str], resolution: str) -> DataFrame:
    """Rows whose resolution is the finest of their key."""
    best = F.min(resolution).over(Window.partitionBy(*keys))
    return df.withColumn("_best", best).where(F.col(resolution) == F.col("_best")).drop("_best")


def widen(df: DataFrame, keys: list[str], column: str, value: str, names: list[str], how: str = "sum", sequence: str | None = None) -> DataFrame:
    """A column for each name. how: sum, or first or last by the sequence in which rows came."""
    folded = {"sum": lambda: F.sum(value), "first": lambda: F.min_by(value, sequence), "last": lambda: F.max_by(value, sequence)}[how]()
    return df.groupBy(*keys).pivot(column, names).agg(folded)


def last_known(df: DataFrame, keys: list[str], value: str, sequence: str, skip_null: bool = False) -> DataFrame:
    """The last value of each key by sequence; with skip_null a value wins over a later null."""
    rows = df.where(F.col(value).isNotNull()) if skip_null else df
    known = rows.groupBy(*keys).agg(F.max_by(value, sequence).alias(value))
    return df.select(*keys).distinct().join(known, keys, "left") if skip_null else known


def signed_net(df: DataFrame, keys: list[str], value: str, positive: Column) -> DataFrame:
    """Sum of values, negative where the condition fails; a total of 0 is null."""
    net = F.sum(F.when(positive, F.col(value)).otherwise(-F.col(value)))
    return df.groupBy(*keys).agg(F.nullif(net, F.lit(0.0)).alias(value))


def combine(a: DataFrame, b: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Both series by key; what one side lacks has its default."""
    out = a.join(b, keys, "full_outer")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def consolidate(parts: dict[object, DataFrame], column: str) -> DataFrame:
    """Tables under one another; the column says which one a row is from. What a table lacks is null."""
    out = None
    for name, df in parts.items():
        part = df.withColumn(column, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def duplicated(df: DataFrame, value: str, names: list[str]) -> DataFrame:
    """One value under several names, such as one that holds for both directions."""
    return df.withColumns({n: F.col(value) for n in names}).drop(value)


def mapped(column: Column, table: dict[str, str]) -> Column:
    """The table's value, null for what it lacks."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[column]
