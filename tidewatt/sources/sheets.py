"""Market spreadsheets as tables: the layout is told from the cells.

All take the rows of :func:`tidewatt.sources.archives.workbook_rows`, and ``file``, the columns that tell
files apart. A sheet's header is one row, found by a cell; that file's rows look back to it. Rows of
:func:`tidewatt.sources.archives.workbook_tables` have it beside them, and need no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions import timegrid as T
from tidewatt.operators.reshape import densify
from tidewatt.plans import market


def _plain(cell: Column) -> Column:
    """A header as one line."""
    return F.trim(F.regexp_replace(cell, r"\s+", " "))


def below(rows: DataFrame, file: list[str], first: list[str], levels: int = 1) -> DataFrame:
    """Rows under the first row of each file that begins with one of the cells ``first``, with ``head``, the
    header's cells as a list for each of its levels; files without one have no rows. With two levels
    the row above holds groups, which run on to the right. Rows that were read with one level's header keep that one."""
    if levels == 1 and "names" in rows.columns:
        return rows.where("error is null" + "".join(f" and `{c}` is not null" for c in file))
    begins = _plain(F.get("cells", F.lit(0)))
    # A merged header may leave its first cell in the row of groups empty.
    named = begins.isin(first) if levels == 1 else F.exists(F.transform("cells", _plain), lambda c: c.isin(first))
    header = [F.col("row").alias("_at"), F.transform("cells", _plain).alias("names")]
    # Files are read once: a row looks back to the first header at or above it, and that to the row above.
    down = Window.partitionBy(*file, "sheet").orderBy("row")
    whole = rows.where("error is null" + "".join(f" and `{c}` is not null" for c in file))
    if levels == 2:
        above = F.lag(F.struct("row", F.transform("cells", _plain).alias("g"))).over(down)
        whole = whole.withColumn("_above", above)
        group = F.when(F.col("_above.row") + 1 == F.col("row"), F.col("_above.g"))
        run_on = lambda c, i: F.try_element_at(F.filter(F.slice(group, F.lit(1), i + 1), lambda x: x.isNotNull() & (x != "")), F.lit(-1))
        header.append(F.transform(group, run_on).alias("groups"))
    found = F.first(F.when(named, F.struct(*header)), ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return whole.withColumn("_h", found).select(*rows.columns, "_h.*").where(F.col("row") > F.col("_at"))


def cell(name: str | Column, group: str | None = None) -> Column:
    """The cell under a header, of a group in two levels; null without one."""
    if group is None:
        at = F.array_position("names", name)
    else:
        both = F.zip_with("groups", "names", lambda g, n: F.coalesce((g == group) & (n == name), F.lit(False)))
        at = F.array_position(both, True)
    return F.when(at > 0, F.get("cells", (at - 1).cast("int")))


def number(name: str | Column, group: str | None = None) -> Column:
    return T.number(cell(name, group))


#: Headers of the quarter-hour layout to columns.
_QUARTERS = {
    "price_15min_eur_mwh": "15 min price (EUR/MWh)", "volume_mwh": "Volume (MWh)", "purchase_15min_products_mwh": "Purchase 15min products (MWh)", "purchase_60min_products_mwh": "Purchase 60min products (MWh)",
    "sale_15min_products_mwh": "Sale 15min products (MWh)", "sale_60min_products_mwh": "Sale 60min products (MWh)", "saldo_dm_mwh": "Saldo DM (MWh)", "export_mwh": "Export (MWh)", "import_mwh": "Import (MWh)",
    "price_60min_ref_eur_mwh": "60 min price reference (EUR/MWh)",
}


#: Cells that headers of day-ahead sheets begin with.
DAY_AHEAD = ["Period", "Hour"]


def day_ahead(rows: DataFrame, file: list[str]) -> DataFrame:
    """file, period, time_interval, prices and volumes of quarters. A sheet whose header begins with Period
    has them; one that begins with Hour has hours, whose prices are copied to their four quarters, and
    volumes divided among them as 60-minute products."""
    table = below(rows, file, DAY_AHEAD).withColumn("is_15min", F.get("names", F.lit(0)) == "Period")
    new = F.col("is_15min")
    # A value is looked up once, by its layout's name, since methods of more code than the JVM compiles would be interpreted.
    either = lambda quarter, hour: number(F.when(new, F.lit(quarter)).otherwise(F.lit(hour)))
    shared = {"volume_mwh": "Volume (MWh)", "purchase_60min_products_mwh": "Volume (MWh)", "sale_60min_products_mwh": "Volume (MWh)", "saldo_dm_mwh": "Saldo DM", "export_mwh": "Export", "import_mwh": "Import"}
    prices = {"price_15min_eur_mwh": "Price (EUR/MWh)", "price_60min_ref_eur_mwh": "Price (EUR/MWh)"}

    def value(c: str, header: str) -> Column:
        if c in shared:
            return either(header, shared[c]) / F.when(new, 1).otherwise(4)
        return either(header, prices[c]) if c in prices else F.when(new, number(header)).otherwise(0.0)

    values = [value(c, h).alias(c) for c, h in _QUARTERS.items()]
    label = F.when(new, T.canonical_label(F.trim(cell("Time interval"))))
    sides = ~new & (F.coalesce(cell("Volume (MWh)"), F.lit("")) == "Sale")
    told = table.where(~sides).select(*file, new, either("Period", "Hour").cast("int").alias("_n"), label.alias("_label"), *values)
    told = told.where("_n is not null and (not is_15min or coalesce(_label, '') <> '')")
    each = told.withColumn("_q", F.explode(F.when(new, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.lit(4)))))
    each = each.withColumn("period", F.when(new, F.col("_n")).otherwise((F.col("_n") - 1) * 4 + F.col("_q")).cast("int"))
    return each.select(*file, "period", F.when(new, F.col("_label")).otherwise(T.period_label(F.col("period"))).alias("time_interval"), *_QUARTERS, "is_15min")


def intraday_auction(rows: DataFrame, file: list[str]) -> DataFrame:
    """file, period, time_interval, price and volumes of a sheet whose header begins with Period, wherever it is."""
    table = below(rows, file, ["Period"])
    names = {"price_eur_mwh": "Price (EUR/MWh)", "volume_mwh": "Volume (MWh)", "saldo_mwh": "Saldo DM (MWh)", "export_mwh": "Export (MWh)", "import_mwh": "Import (MWh)"}
    out = table.select(*file, number("Period").cast("int").alias("period"), T.canonical_label(F.trim(cell("Time interval"))).alias("time_interval"), *[number(h).alias(c) for c, h in names.items()])
    return out.where("period is not null")


#: Groups of the trade balance.
_GROUPS = ("Total", "Daily market", "Intraday auction", "Intraday market", "Realization diagrams")


def trade_balance(rows: DataFrame, file: list[str]) -> DataFrame:
    """file, delivery_date, period and twenty volumes: bought and sold by group, in MW and MWh. Days have all 96
    periods; those that a sheet lacks are 0.0. Of rows that share a period the last one counts."""
    table = below(rows, file, ["Delivery day"], 2)
    volumes = {f"{g.lower().replace(' ', '_')}_{side.lower()}_{unit.lower()}": number(f"{side} ({unit})", g) for unit in ("MW", "MWh") for g in _GROUPS for side in ("Buy", "Sell")}
    ends = F.split(F.replace(cell("Period"), F.lit(" "), F.lit("")), "-")
    clock = F.split(ends[0], ":")
    period = (clock[0].try_cast("int") * 4 + F.floor(F.get(clock, F.lit(1)).try_cast("int") / 15) + 1).cast("int")
    day = F.coalesce(F.try_to_timestamp(F.substring(cell("Delivery day"), 1, 10), F.lit("yyyy-MM-dd")).cast("date"), F.date_add(F.lit("1899-12-30").cast("date"), cell("Delivery day").try_cast("double").cast("int")))
    out = table.select(*file, "row", day.alias("delivery_date"), period.alias("period"), *[v.alias(c) for c, v in volumes.items()]).where("delivery_date is not null and period is not null")
    last = out.groupBy(*file, "delivery_date", "period").agg(F.max_by(F.struct(*volumes), "row").alias("v")).select(*file, "delivery_date", "period", "v.*")
    return densify(last, [*file, "delivery_date"], list(volumes))


def ticks(rows: DataFrame, file: list[str], day: Column, skip: int = 4) -> DataFrame:
    """Trades of sheets whose columns are known by their place, below so many rows."""
    names = ["contract", "period_from", "period_to", "aggressor", "qty_mw", "qty_mwh", "price_eur_mwh", "amount_eur", "exec_time"]
    body = rows.where(F.col("error").isNull() & (F.col("row") > skip))
    text = body.select(*file, "row", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(names)])
    return market.trade_ticks(text, file, "row", day)
