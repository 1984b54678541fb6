"""Events that last and are revised: their overlap with a grid, and capacity per slot.

An overlap join against a grid is not a theta join: each event is expanded to the slots it touches,
which bounds the work by the result, and meets the grid by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slots_of(events: DataFrame, start: str, end: str, step: str) -> DataFrame:
    """Adds slot, a row for each slot [slot, slot + step) that [start, end) overlaps; slots are whole
    steps of days or minutes. Events that end where they start overlap nothing."""
    number, unit = step.split()
    if unit.startswith("day"):
        first, last = F.to_date(start), F.to_date(F.col(end) - F.expr("interval 1 microsecond"))
        grid = F.sequence(first, last, F.expr(f"interval {step}"))
    else:
        n = int(number)
        floor = lambda c: F.date_trunc("hour", c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n) * F.floor(F.minute(c) / n).cast("int"))
        grid = F.sequence(floor(F.col(start)), floor(F.col(end) - F.expr("interval 1 microsecond")), F.expr(f"interval {step}"))
    return events.where(F.col(start) < F.col(end)).withColumn("slot", F.explode(grid))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in the order; give a total one."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def as_known(rows: DataFrame, created: str, at: Column) -> DataFrame:
    """What had been published at a time, for decisions that must not look ahead."""
    return rows.where(F.col(created) <= at)


def capacity(grid: DataFrame, events: DataFrame, start: str, end: str, step: str, unit: str, order: list[Column], active: Column, unavailable: Column, groups: dict[str, Column]) -> DataFrame:
    """Per slot of the grid (column slot): n_units and sums of what is unavailable, in all and by
    group. Of each unit the latest version that overlaps the slot counts, if it is active; slots
    without events are there with zeros."""
    touched = slots_of(events, start, end, step)
    now = latest(touched, ["slot", unit], order).where(active).withColumn("_u", F.greatest(unavailable, F.lit(0.0)))
    sums = [F.coalesce(F.sum(F.when(c, F.col("_u"))), F.lit(0.0)).alias(name) for name, c in groups.items()]
    per = now.groupBy("slot").agg(F.count("*").alias("n_units"), F.sum("_u").alias("total"), *sums)
    names = ["total", *groups]
    return grid.join(per, "slot", "left").select(*grid.columns, F.coalesce("n_units", F.lit(0)).alias("n_units"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names])


def as_of(left: DataFrame, right: DataFrame, keys: list[str], on: str, value: str, block_days: int = 28) -> DataFrame:
    """Adds value of right's last row at or before each left row. Both sides are put in one order
    and the value is carried along, so no pairs arise. Without keys the order is made in blocks of
    days, and each block is handed the last value of those before it, of which there is one a block."""
    a = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType))
    b = right.select(*keys, on, F.col(value).alias("_v")).withColumn("_side", F.lit(0))
    both = a.unionByName(b, allowMissingColumns=True)
    parts = keys
    if not keys:
        parts = ["_block"]
        both = both.withColumn("_block", F.floor(F.datediff(on, F.lit("1970-01-01").cast("date")) / block_days))
        ends = both.groupBy("_block").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(on))).alias("_end"))
        before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        both = both.join(ends.select("_block", F.last("_end", ignorenulls=True).over(before).alias("_carried")), "_block", "left")
    w = Window.partitionBy(*parts).orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    known = F.last("_v", ignorenulls=True).over(w)
    out = both.withColumn(value, known if keys else F.coalesce(known, "_carried")).where("_side = 1")
    return out.drop("_side", "_v", "_block", "_carried")


def known_at(asked: DataFrame, versions: DataFrame, keys: list[str], at: str, decided: str, start: str, end: str, created: str, order: list[str], values: list[str], step: str) -> DataFrame:
    """Adds to each row of asked, for its keys, its slot ``at`` and its own time of decision, the values of
    the version valid in the slot that was the newest then: of those created at or before the decision
    the last by created and order. A revision that arrives late changes only decisions after it; rows
    without a version have nulls.

    Versions are expanded to the slots that they are valid in, which bounds the work by them, and both sides
    are put in one order by time within a key's slot, where what is known is carried along: no pairs
    arise, and a key with very many rows is dealt out by slots."""
    marks = slots_of(versions.where(F.col(created).isNotNull()), start, end, step)
    told = marks.select(*keys, F.col("slot").alias(at), F.col(created).alias("_t"), F.lit(0).alias("_side"), F.struct(*[F.col(c) for c in order], F.lit(0)).alias("_o"), F.struct(*values).alias("_v"))
    rows = asked.withColumn("_t", F.col(decided)).withColumn("_side", F.lit(1))
    both = rows.unionByName(told, allowMissingColumns=True)
    w = Window.partitionBy(*keys, at).orderBy("_t", "_side", "_o").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_known", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    known = F.when(F.col(decided).isNotNull(), F.col("_known"))
    return out.select(*asked.columns, *[known[c].alias(c) for c in values])
