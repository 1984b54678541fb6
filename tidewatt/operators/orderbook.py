"""Auction order books: clearing, the next unmatched step, walls, and cumulative curves.

A bid has book keys (a day and a period), side buy or sell, price, volume and matched volume. All
books are computed together; every window and join carries the book's keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clearing(bids: DataFrame, prices: DataFrame, keys: list[str]) -> DataFrame:
    """keys, clearing_price, clearing_volume (of matched sells). The official price decides; books
    without one, or without a matched sell, are left out. prices: keys, clearing_price."""
    sold = bids.where("side = 'sell' and volume_matched > 0").groupBy(*keys).agg(F.sum("volume_matched").alias("clearing_volume"))
    return prices.select(*keys, "clearing_price").where("clearing_price is not null").join(sold, keys)


def next_step(bids: DataFrame, cleared: DataFrame, keys: list[str], side: str, ties: list[str]) -> DataFrame:
    """keys, <name>_next_price, _next_volume (of the first bid), _price_gap, _volume_gap (of all
    bids at that price): the nearest bid past the clearing price of which nothing was matched."""
    name, sell = ("supply", True) if side == "sell" else ("demand", False)
    p, c = F.col("price"), F.col("clearing_price")
    rows = bids.where((F.col("side") == side) & (F.col("volume_matched") == 0)).join(cleared.select(*keys, "clearing_price"), keys).where(p > c if sell else p < c)
    first = F.struct((p if sell else -p).alias("_p"), *ties, F.col("volume_bid").alias("_volume"))
    steps = rows.groupBy(*keys, "clearing_price", "price").agg(F.min(first).alias("_f"), F.sum("volume_bid").alias("_gap"))
    best = steps.groupBy(*keys, "clearing_price").agg(F.min(F.struct((p if sell else -p).alias("_p"), "price", F.col("_f._volume").alias("_volume"), "_gap")).alias("_b"))
    return best.select(*keys, F.col("_b.price").alias(f"{name}_next_price"), F.col("_b._volume").alias(f"{name}_next_volume"), F.abs(F.col("_b.price") - c).alias(f"{name}_price_gap"), F.col("_b._gap").alias(f"{name}_volume_gap"))


def summary(bids: DataFrame, prices: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """A row for each priced book: clearing and the next steps of both sides. A side without one
    has nulls, and 0 as its volume gap."""
    cleared = clearing(bids, prices, keys)
    out = cleared
    for side in ("sell", "buy"):
        out = out.join(next_step(bids, cleared, keys, side, ties), keys, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("supply_volume_gap", "demand_volume_gap")})


#: Walls: side, and whether they lie where prices rise from the clearing price.
_WALLS = {"supply": ("sell", True), "supply_matched": ("sell", False), "demand": ("buy", False), "demand_matched": ("buy", True)}


def walls(bids: DataFrame, cleared: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """keys, clearing_price, and for each of four ways <name>_mw, _price, _slope: where going away
    from the clearing price meets the largest jump between neighbouring bids; of equal jumps the
    closest. The ways lead past the clearing price for sells (supply) and buys (demand), and back
    over the matched bids of each. The slope is null at 0 MW. A bid lies on one way at most, so all
    four share the exchange and the sort of the books."""
    p, c = F.col("price"), F.col("clearing_price")
    on = [F.when((F.col("side") == side) & (p > c if up else p < c), name) for name, (side, up) in _WALLS.items()]
    rows = bids.join(cleared.select(*keys, "clearing_price"), keys).withColumn("_way", F.coalesce(*on)).where("_way is not null")
    rising = F.col("_way").isin([name for name, (_, up) in _WALLS.items() if up])
    order = Window.partitionBy(*keys, "_way").orderBy(F.when(rising, p).otherwise(-p), *ties)
    steps = rows.withColumns({"_before": F.lag("price").over(order), "_mw": F.coalesce(F.sum("volume_bid").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))}).where("_before is not null")
    step = F.struct((-F.abs(p - F.col("_before"))).alias("_jump"), F.col("_mw").alias("mw"), *[F.col(t).alias(f"_{t}") for t in ties], (p - c).alias("price"))
    best = steps.groupBy(*keys).agg(*[F.min(F.when(F.col("_way") == name, step)).alias(name) for name in _WALLS])
    columns = []
    for name in _WALLS:
        mw, price = F.col(f"{name}.mw"), F.col(f"{name}.price")
        columns += [mw.alias(f"{name}_mw"), price.alias(f"{name}_price"), F.when(mw > 0, price / mw).alias(f"{name}_slope")]
    return cleared.select(*keys, "clearing_price").join(best, keys, "left").select(*keys, "clearing_price", *columns)


def curve(bids: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """Adds volume_from and volume_to, the segment that a bid covers of its side's curve: supply by
    rising, demand by falling price. A matched bid covers what was matched, another all of its volume."""
    part = F.when(F.col("volume_matched") > 0, F.col("volume_matched")).otherwise(F.col("volume_bid"))
    along = F.when(F.col("side") == "sell", F.col("price")).otherwise(-F.col("price"))
    end: Column = F.sum(part).over(Window.partitionBy(*keys, "side").orderBy(along, *ties).rowsBetween(Window.unboundedPreceding, 0))
    return bids.withColumn("volume_to", end).withColumn("volume_from", end - part)
