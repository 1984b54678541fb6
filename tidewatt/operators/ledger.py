"""What late or corrected data make stale, and recomputing only that.

A ledger is a table of intervals to be computed again: layer, keys, start, the run that found them, and
whether they are done. Touched quarters are entered; hours of touched quarters are stale, and so is
every row whose rolling frame, which counts rows, reaches back to a stale hour. Each layer is
computed again for its stale rows only, from the layer below, and replaces what it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions.timegrid import floor_to, spine


def touched(rows: DataFrame, ts: str, keys: list[str], minutes: int = 15) -> DataFrame:
    """keys, start of the buckets that rows fall in; at most one row a bucket leaves a task."""
    return rows.where(F.col(ts).isNotNull()).select(*keys, floor_to(F.col(ts), minutes).alias("start")).distinct()


def trailing(table: DataFrame, ts: str, keys: list[str], now: Column, days: int, minutes: int = 15) -> DataFrame:
    """The buckets of the last days before now, which are computed again whatever came."""
    return touched(table.where((F.col(ts) >= now - F.make_dt_interval(F.lit(days))) & (F.col(ts) < now)), ts, keys, minutes)


def coarser(stale: DataFrame, keys: list[str], unit: str = "hour") -> DataFrame:
    """The hours, or days, of stale buckets."""
    return stale.select(*keys, F.date_trunc(unit, "start").alias("start")).distinct()


def reached(table: DataFrame, stale: DataFrame, keys: list[str], start: str, rows: int, block_days: int = 28, backward: bool = False) -> DataFrame:
    """keys, start of the table's rows that are stale, or have a stale row among so many rows before
    them; backward, after them. Stale rows that the table has no more count at their place. With keys one ordered pass for
    each; without, in blocks of days, each of which also gets the last positions of stale rows before it."""
    live = table.select(*keys, F.col(start).alias("start")).withColumn("_live", F.lit(1))
    marks = stale.select(*keys, "start").withColumn("_stale", F.lit(1))
    both = live.join(marks, [*keys, "start"], "full_outer").select(*keys, "start", F.coalesce("_live", F.lit(0)).alias("_live"), F.coalesce("_stale", F.lit(0)).alias("_stale"))
    way = F.desc if backward else F.asc
    if keys:
        order = Window.partitionBy(*keys).orderBy(way("start"))
        numbered = both.withColumn("_i", F.sum("_live").over(order))
        last = F.max(F.when(F.col("_stale") == 1, F.col("_i") + 1 - F.col("_live"))).over(order)
    else:
        both = both.withColumn("_block", F.floor(F.datediff("start", F.lit("1970-01-01").cast("date")) / block_days))
        own = Window.partitionBy("_block").orderBy(way("start"))
        inside = both.withColumn("_k", F.sum("_live").over(own))
        # One row a block: how many rows it has, and where its last stale row stands.
        ends = inside.groupBy("_block").agg(F.sum("_live").alias("_n"), F.max(F.when(F.col("_stale") == 1, F.col("_k") + 1 - F.col("_live"))).alias("_m"))
        blocks = Window.orderBy(way("_block")).rowsBetween(Window.unboundedPreceding, -1)
        before = ends.select("_block", F.coalesce(F.sum("_n").over(blocks), F.lit(0)).alias("_before"), "_m")
        before = before.select("_block", "_before", F.max(F.col("_m") + F.col("_before")).over(blocks).alias("_carried"))
        numbered = inside.join(before, "_block").withColumn("_i", F.col("_k") + F.col("_before"))
        last = F.greatest(F.max(F.when(F.col("_stale") == 1, F.col("_i") + 1 - F.col("_live"))).over(own), F.col("_carried"))
    # The position that a stale row has, or, of one that is gone, that of the next row.
    return numbered.withColumn("_last", last).where((F.col("_live") == 1) & (F.col("_i") - F.col("_last") <= rows)).select(*keys, "start")


def recomputed(old: DataFrame, stale: DataFrame, keys: list[str], start: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """old without its stale rows, and what compute(stale) gives for them."""
    on = [*keys, start]
    wanted = stale.withColumnRenamed("start", start)
    return old.join(wanted, on, "left_anti").unionByName(compute(wanted).select(*old.columns))


def only(rows: DataFrame, stale: DataFrame, keys: list[str], start: Column) -> DataFrame:
    """The rows of stale buckets, whose start is given."""
    kept = rows.columns
    marked = rows.withColumn("_s", start).join(stale.select(*keys, F.col("start").alias("_s")), [*keys, "_s"], "left_semi")
    return marked.select(*kept)


# The ledger itself.

LEDGER = "layer string, key string, start timestamp_ntz, run long, done boolean"


def enter(stale: DataFrame, layer: str, keys: list[str], run: int) -> DataFrame:
    """Entries of stale buckets."""
    return stale.select(F.lit(layer).alias("layer"), F.to_json(F.struct(*keys)).alias("key") if keys else F.lit("{}").alias("key"), F.col("start").cast("timestamp_ntz").alias("start"), F.lit(run).cast("long").alias("run"), F.lit(False).alias("done"))


def pending(ledger: DataFrame, layer: str) -> DataFrame:
    """The entries of a layer that no later or equal run marks as done, each once, with the newest run
    that entered them. A run that fails leaves its entries pending."""
    by = ledger.where(F.col("layer") == layer).groupBy("layer", "key", "start")
    out = by.agg(F.max(F.when(~F.col("done"), F.col("run"))).alias("run"), F.max(F.when(F.col("done"), F.col("run"))).alias("_done"))
    return out.where("run is not null and (_done is null or _done < run)").drop("_done")


def finished(entries: DataFrame, run: int) -> DataFrame:
    """Marks of entries as done by a run, to be appended."""
    return entries.select("layer", "key", "start", F.lit(run).cast("long").alias("run"), F.lit(True).alias("done"))


# Gaps and their refill.


def gaps(table: DataFrame, start: str, keys: list[str], first: Column, last: Column, step: str) -> DataFrame:
    """keys, start of the steps from first to last that a key which the table has lacks. first and
    last may be of the key's own rows, as aggregates. Bounded by keys times steps."""
    there = table.groupBy(*keys).agg(first.alias("_a"), last.alias("_b")) if keys else table.agg(first.alias("_a"), last.alias("_b"))
    grid = there.where("_a is not null and _b is not null and _a <= _b").select(*keys, spine(F.col("_a"), F.col("_b"), step).alias("start"))
    return grid.join(table.select(*keys, F.col(start).alias("start")).distinct(), [*keys, "start"], "left_anti")


def refilled(table: DataFrame, source: DataFrame, missing: DataFrame, keys: list[str], start: str) -> DataFrame:
    """The table, and the source's rows for what is missing; what the source lacks too stays missing."""
    return table.unionByName(only(source, missing, keys, F.col(start)).select(*table.columns))
