"""Exact quantiles of groups of any size, by counting.

A group's values are counted in bins, by powers of two and then of equal width between the least and largest
one, and the bins that hold the wanted ranks are counted again more finely, until a bin is one value: at
``BINS`` bins that takes seven rounds at most, whatever the values. Counts are partial aggregates, so a task never
holds a group's values, and a group that has all rows is counted by all tasks. Each round reads
only rows of bins that are still open; what is kept of a group is at most ``BINS`` counts a rank.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.scratch import scratch

BINS = 1024


def _saved(df: DataFrame, path: str, name: str) -> DataFrame:
    df.write.parquet(f"{path}/{name}")
    return df.sparkSession.read.parquet(f"{path}/{name}")


def quantiles(df: DataFrame, keys: list[str], value: Column | str, shares: dict[str, float], bins: int = BINS) -> DataFrame:
    """keys and, for each name of shares, the value at that share of the sorted values, interpolated between
    neighbours as PERCENTILE_CONT does. Values are taken as doubles; nulls and values that are no number are
    left out, infinities too; groups without a value have nulls. A key may be null."""
    if any(not 0 <= s <= 1 for s in shares.values()):
        raise ValueError("quantiles: shares are between 0 and 1")
    path = scratch(df.sparkSession, "quantiles")
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], v.alias("v"))
    names = [f"_k{i}" for i in range(len(keys))]
    good = F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < math.inf)
    groups = _saved(rows.groupBy(*names).agg(F.count_if(good).alias("n"), F.min(F.when(good, F.col("v"))).alias("low"), F.max(F.when(good, F.col("v"))).alias("high")), path, "groups")
    # Equal values are one row from here on.
    rows = _saved(rows.where(good).groupBy(*names, "v").agg(F.count("*").alias("c")), path, "values")
    places = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(share) * (F.col("n") - 1)).alias("place")) for name, share in shares.items()])
    wanted = groups.where("n > 0").select(*names, "n", "low", "high", F.explode(places).alias("_p"))
    ends = F.array(F.floor("_p.place"), F.least(F.floor("_p.place") + 1, F.col("n") - 1))
    wanted = wanted.select(*names, "low", "high", F.explode(F.array_distinct(ends)).alias("rank")).distinct()
    # A rank counts from 0 in its group; skip is how many values lie below the open bin.
    open_ = _saved(wanted.withColumn("skip", F.lit(0).cast("long")), path, "open0")
    done, turn = [open_.where("low = high").select(*names, "rank", F.col("low").alias("x"))], 0
    while True:
        still = open_.where("low < high")
        if still.isEmpty():
            break
        turn += 1
        # Ranks in one bin share its counts.
        spans = still.select(*names, "low", "high", "skip").distinct()
        near = _match(rows, spans, names).where("v >= low and v <= high")
        wide = _binade("low") != _binade("high")
        half = F.col("high") / 2 - F.col("low") / 2  # so that the width can't overflow
        number = F.least(F.floor(F.try_divide(F.col("v") / 2 - F.col("low") / 2, half) * bins), F.lit(bins)).cast("int")
        number = F.coalesce(number, F.when(F.col("v") > F.col("low"), bins).otherwise(0))
        number = F.when(wide, _binade("v")).otherwise(number)
        counts = near.withColumn("b", number).groupBy(*names, "low", "high", "skip", "b").agg(F.sum("c").alias("c"), F.min("v").alias("a"), F.max("v").alias("z"))
        below = F.sum("c").over(Window.partitionBy(*names, "low", "high").orderBy("b")) + F.col("skip")
        counts = counts.select(*names, F.col("low").alias("_l"), F.col("high").alias("_h"), "a", "z", below.alias("end"), (below - F.col("c")).alias("begin"))
        on = (F.col("s.low") == F.col("_l")) & (F.col("s.high") == F.col("_h")) & (F.col("s.rank") >= F.col("begin")) & (F.col("s.rank") < F.col("end"))
        for k in names:
            on = on & F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}"))
        found = still.alias("s").join(counts.alias("c"), on).select(*[F.col(f"s.{k}").alias(k) for k in names], F.col("a").alias("low"), F.col("z").alias("high"), F.col("s.rank").alias("rank"), F.col("begin").alias("skip"))
        open_ = _saved(found, path, f"open{turn}")
        done.append(open_.where("low = high").select(*names, "rank", F.col("low").alias("x")))
    exact = done[0]
    for more in done[1:]:
        exact = exact.unionByName(more)
    held = exact.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("_x"))
    out = groups.alias("g").join(held.alias("h"), _same(names, "g", "h"), "left")
    at = lambda place: F.try_element_at("_x", place.cast("long"))

    def made(share: float) -> Column:
        place = F.lit(share) * (F.col("n") - 1)
        low, high = at(F.floor(place)), at(F.least(F.floor(place) + 1, F.col("n") - 1))
        part = place - F.floor(place)
        return F.when(part == 0, low).otherwise(low + part * (high - low))

    return out.select(*[F.col(f"g.{n}").alias(k) for n, k in zip(names, keys)], *[made(s).alias(name) for name, s in shares.items()])


def _binade(x: str) -> Column:
    """The power of two below a number, in the order of the numbers themselves."""
    return F.when(F.col(x) == 0, 0).otherwise(F.signum(x) * (F.floor(F.log2(F.abs(x))) + 1080)).cast("int")


def _same(names: list[str], a: str, b: str) -> Column:
    on = F.lit(True)
    for k in names:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def _match(rows: DataFrame, spans: DataFrame, names: list[str]) -> DataFrame:
    """rows with the open spans of their group."""
    if not names:
        return rows.crossJoin(F.broadcast(spans))  # a row for each open rank of the one group
    joined = rows.alias("r").join(spans.alias("s"), _same(names, "r", "s"))
    return joined.select(*[F.col(f"r.{k}").alias(k) for k in names], "v", "c", "low", "high", "skip")
