"""The operators applied to the driver's tables, each with SQL that says the same.

The tables are not market tables, so each query states its analogue: events are minute data and
event types their series; order lines are bids, orders the official prices or the outages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions import stats
from tidewatt.functions import timegrid as T
from tidewatt.operators import checks, intervals, orderbook, resample, reshape, upsert
from tidewatt.sources import documents as sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarters(events: DataFrame) -> DataFrame:
    rules = {"value_mean": ("mean", "value"), "value_median": ("median", "value"), "value_last": ("last", "value")}
    return resample.downsample(events, "ts", rules, ["event_type"], 15, ["ts", "event_id"])


_Q15 = """q as (select event_type, cast(ts as date) trade_date, strftime(time_bucket(interval 15 minute, ts), '%H:%M') || '-' || strftime(time_bucket(interval 15 minute, ts) + interval 15 minute, '%H:%M') time_interval,
 avg(value) value_mean, median(value) value_median, last(value order by ts, event_id) value_last from events group by event_type, cast(ts as date), time_bucket(interval 15 minute, ts))"""
_HOUR = "substring(time_interval, 1, 2) || ':00-' || lpad(cast((cast(substring(time_interval, 1, 2) as int) + 1) % 24 as varchar), 2, '0') || ':00'"


@query(f"with {_Q15} select event_type, trade_date, time_interval, round(value_mean, 6) value_mean, round(value_median, 6) value_median, value_last from q")
def resample15_stats(spark, sf_dir):
    q = _quarters(_t(spark, sf_dir, "events"))
    return q.withColumns({c: F.round(c, 6) for c in ("value_mean", "value_median")})


@query(f"with {_Q15} select event_type, trade_date, {_HOUR} time_interval, round(avg(value_mean), 8) value_mean, round(avg(value_median), 8) value_median, last(value_last order by time_interval) value_last from q group by all having count(distinct q.time_interval) = 4")
def resample60_gated(spark, sf_dir):
    rules = {"value_mean": ("mean", "value_mean"), "value_median": ("mean", "value_median"), "value_last": ("last", "value_last")}
    return resample.roll_up(_quarters(_t(spark, sf_dir, "events")), rules, ["event_type"]).withColumns({c: F.round(c, 8) for c in ("value_mean", "value_median")})


@query(f"with {_Q15} select event_type, trade_date, {_HOUR} hour_interval, count(distinct q.time_interval) as quarters from q group by all having count(distinct q.time_interval) < 4")
def partial_hours(spark, sf_dir):
    return resample.incomplete_hours(_quarters(_t(spark, sf_dir, "events")), ["event_type"])


@query(f"with {_Q15}, c as (select event_type, trade_date, {_HOUR} h from q group by all having count(distinct q.time_interval) = 4) select q.event_type, q.trade_date, q.time_interval, q.value_last from q join c on c.event_type = q.event_type and c.trade_date = q.trade_date and c.h = {_HOUR}")
def partial_cleanup(spark, sf_dir):
    q = _quarters(_t(spark, sf_dir, "events")).withColumn("_h", T.hour_label(F.col("time_interval")))
    full = q.groupBy("event_type", "trade_date", "_h").agg(F.count_distinct("time_interval").alias("n")).where("n = 4")
    return upsert.delete_without(q, full, ["event_type", "trade_date", "_h"]).select("event_type", "trade_date", "time_interval", "value_last")


@query("""select date_trunc('hour', ts) hour_start, count(*) n, min(value) value_min, max(value) value_max, max(value) - min(value) value_range, round(stddev_samp(value), 4) value_std,
 round(case when count(value) >= 3 then skewness(value) end, 4) value_skew, round(regr_slope(value, minute(ts)), 4) value_slope, count(*) filter (where value <= 5) low_count, count(*) filter (where value >= 100) peak_count
 from events group by 1 having count(*) >= 10""")
def native60_features(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").withColumn("hour_start", F.date_trunc("hour", "ts"))
    out = rows.groupBy("hour_start").agg(F.count("*").alias("n"), *resample.moments("value", "value"), stats.slope("value", F.minute("ts")).alias("value_slope"), F.count_if(F.col("value") <= 5).alias("low_count"), F.count_if(F.col("value") >= 100).alias("peak_count"))
    return out.where("n >= 10").withColumns({c: F.round(c, 4) for c in ("value_std", "value_skew", "value_slope")})


@query("""with m as (select date_trunc('minute', ts) as tm, event_type, avg(value) v from events group by 1, 2),
 a as (select tm, v from m where event_type = 'click'), b as (select tm, v from m where event_type = 'view'), c as (select tm, v from m where event_type = 'purchase'),
 l as (select cast(tm as date) d, quantile_cont(abs(v), 0.95) p from a group by 1),
 j as (select a.tm, a.v x, b.v y, c.v z, abs(a.v) >= coalesce(l.p, 999999) * 0.95 s from a left join b on b.tm = a.tm left join c on c.tm = a.tm left join l on l.d = cast(a.tm as date))
 select date_trunc('hour', tm) hour_start, count(*) n, case when count(*) >= 4 then round(max(x) - min(x), 6) end x_range, case when count(*) >= 4 then round(stddev_samp(x), 4) end x_std,
 case when count(*) >= 4 then count(*) filter (where s) end saturation_count, case when count(*) >= 4 then round(avg(x + y), 6) end sum_mean, case when count(*) >= 4 then count(*) filter (where y <> 0 or z <> 0) end active_count from j group by 1""")
def minute_features(spark, sf_dir):
    m = _t(spark, sf_dir, "events").groupBy(F.date_trunc("minute", "ts").alias("at"), "event_type").agg(F.avg("value").alias("v"))
    part = lambda kind, name: m.where(F.col("event_type") == kind).select("at", F.col("v").alias(name))
    j = part("click", "x").join(part("view", "y"), "at", "left").join(part("purchase", "z"), "at", "left")
    j = resample.saturation(j.withColumn("day", F.to_date("at")), "x", "day")
    names = {
        "x_range": F.round(F.max("x") - F.min("x"), 6), "x_std": F.round(F.stddev_samp("x"), 4), "saturation_count": F.count_if("saturated"),
        "sum_mean": F.round(F.avg(F.col("x") + F.col("y")), 6), "active_count": F.count_if((F.col("y") != 0) | (F.col("z") != 0)),
    }
    out = j.groupBy(F.date_trunc("hour", "at").alias("hour_start")).agg(F.count("*").alias("n"), *[c.alias(k) for k, c in names.items()])
    return resample.gated(out, "n", 4, list(names))


@query("""with l as (select cast(ts as date) d, quantile_cont(abs(value), 0.95) p from events group by 1)
 select d trade_date, round(any_value(p), 6) p95, count(*) filter (where abs(value) >= coalesce(p, 999999) * 0.95) saturated, count(*) n from events join l on l.d = cast(ts as date) group by 1""")
def daily_saturation(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").withColumn("trade_date", F.to_date("ts"))
    flagged = resample.saturation(rows, "value", "trade_date")
    return flagged.groupBy("trade_date").agg(F.round(stats.quantile(F.abs("value"), 0.95), 6).alias("p95"), F.count_if("saturated").alias("saturated"), F.count("*").alias("n"))


@query("""with h as (select date_trunc('hour', ts) hour_start, avg(value) v from events group by 1)
 select hour_start, round(avg(v) over (order by hour_start rows 7 preceding), 8) roll_8, round(avg(v) over (order by hour_start rows 15 preceding), 8) roll_16, round(sum(v) over (order by hour_start rows 15 preceding), 8) integral_16 from h""")
def rolling_memory(spark, sf_dir):
    h = _t(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour_start")).agg(F.avg("value").alias("v")).withColumn("day", F.to_date("hour_start"))
    out = resample.rolling_blocks(h, "v", "day", ["hour_start"], {"roll_8": ("mean", 7), "roll_16": ("mean", 15), "integral_16": ("sum", 15)})
    return out.select("hour_start", *[F.round(c, 8).alias(c) for c in ("roll_8", "roll_16", "integral_16")])


@query("""with a as (select time_bucket(interval 15 minute, ts) b, avg(value) v from events where event_type = 'click' group by 1), f as (select time_bucket(interval 15 minute, ts) b, avg(value) v from events where event_type = 'view' group by 1)
 select a.b bucket, round(a.v, 6) actual, round(f.v, 6) forecast, round(a.v - f.v, 6) error, round(coalesce(a.v, 0) + coalesce(f.v, 0), 6) total from a left join f on f.b = a.b""")
def forecast_error(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("bucket", T.floor_to(F.col("ts"), 15))
    part = lambda kind, name: e.where(F.col("event_type") == kind).groupBy("bucket").agg(F.avg("value").alias(name))
    j = part("click", "actual").join(part("view", "forecast"), "bucket", "left")
    return j.select("bucket", F.round("actual", 6).alias("actual"), F.round("forecast", 6).alias("forecast"), F.round(F.col("actual") - F.col("forecast"), 6).alias("error"), F.round(stats.none_as_zero("actual", "forecast"), 6).alias("total"))


_TIES = ["volume_bid", "volume_matched", "part", "supplier", "line", "tax"]


def _book(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    li = _t(spark, sf_dir, "lineitem")
    matched = F.when(F.col("l_discount") >= 0.05, F.col("l_quantity")).otherwise(0.0)
    bids = li.select(F.col("l_orderkey").alias("period"), F.when(F.col("l_linestatus") == "O", "sell").otherwise("buy").alias("side"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("volume_bid"), matched.alias("volume_matched"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"), F.col("l_tax").alias("tax"))
    prices = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("period"), (F.col("o_totalprice") / 5).alias("clearing_price"))
    return bids, prices


_BOOK = """b as (select l_orderkey as period, case when l_linestatus = 'O' then 'sell' else 'buy' end side, l_extendedprice price, l_quantity volume_bid, case when l_discount >= 0.05 then l_quantity else 0.0 end volume_matched, l_partkey part, l_suppkey supplier, l_linenumber line, l_tax tax from lineitem),
 c as (select o_orderkey as period, o_totalprice / 5 clearing_price, sum(volume_matched) clearing_volume from orders join b on b.period = o_orderkey where side = 'sell' and volume_matched > 0 group by 1, 2)"""
_TIE_SQL = "volume_bid, volume_matched, part, supplier, line, tax"


def _next_sql(name: str, side: str, sign: str, order: str) -> str:
    return f"""{name} as (select period, price p, volume_bid v, sum(volume_bid) over (partition by period, price) gap, row_number() over (partition by period order by price {order}, {_TIE_SQL}) rn
 from b join c using (period) where side = '{side}' and volume_matched = 0 and price {sign} clearing_price)"""


@query(f"""with {_BOOK}, {_next_sql("s", "sell", ">", "asc")}, {_next_sql("d", "buy", "<", "desc")}
 select c.period as period, c.clearing_price, c.clearing_volume, s.p supply_next_price, s.v supply_next_volume, s.p - c.clearing_price supply_price_gap, coalesce(s.gap, 0) supply_volume_gap,
 d.p demand_next_price, d.v demand_next_volume, c.clearing_price - d.p demand_price_gap, coalesce(d.gap, 0) demand_volume_gap
 from c left join s on s.period = c.period and s.rn = 1 left join d on d.period = c.period and d.rn = 1""")
def orderbook_summary(spark, sf_dir):
    bids, prices = _book(spark, sf_dir)
    return orderbook.summary(bids, prices, ["period"], _TIES)


def _wall_sql(name: str, side: str, sign: str, order: str) -> str:
    return f"""{name}1 as (select period, price, clearing_price, {_TIE_SQL}, lag(price) over w prev, coalesce(sum(volume_bid) over (w rows between unbounded preceding and 1 preceding), 0) mw
 from b join c using (period) where side = '{side}' and price {sign} clearing_price window w as (partition by period order by price {order}, {_TIE_SQL})),
 {name} as (select period, mw {name}_mw, price - clearing_price {name}_price, case when mw > 0 then (price - clearing_price) / mw end {name}_slope from {name}1 where prev is not null
 qualify row_number() over (partition by period order by abs(price - prev) desc, mw, {_TIE_SQL}) = 1)"""


@query(f"""with {_BOOK}, {_wall_sql("supply", "sell", ">", "asc")}, {_wall_sql("supply_matched", "sell", "<", "desc")}, {_wall_sql("demand", "buy", "<", "desc")}, {_wall_sql("demand_matched", "buy", ">", "asc")}
 select c.period as period, c.clearing_price, supply_mw, supply_price, supply_slope, supply_matched_mw, supply_matched_price, supply_matched_slope, demand_mw, demand_price, demand_slope, demand_matched_mw, demand_matched_price, demand_matched_slope
 from c left join supply on supply.period = c.period left join supply_matched on supply_matched.period = c.period left join demand on demand.period = c.period left join demand_matched on demand_matched.period = c.period""")
def curve_walls(spark, sf_dir):
    bids, prices = _book(spark, sf_dir)
    return orderbook.walls(bids, orderbook.clearing(bids, prices, ["period"]), ["period"], _TIES)


@query(f"""with {_BOOK} select period, side, price, part, supplier, line, volume_to - step volume_from, volume_to from (select *, case when volume_matched > 0 then volume_matched else volume_bid end step,
 sum(case when volume_matched > 0 then volume_matched else volume_bid end) over (partition by period, side order by case when side = 'sell' then price else -price end, {_TIE_SQL} rows unbounded preceding) volume_to from b)""")
def supply_curve(spark, sf_dir):
    bids, _ = _book(spark, sf_dir)
    return orderbook.curve(bids, ["period"], _TIES).select("period", "side", "price", "part", "supplier", "line", "volume_from", "volume_to")


@query("""select date_trunc('month', l_shipdate) ship_month, l_returnflag, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 4) price, sum(l_quantity) volume from lineitem group by 1, 2""")
def vwap_by_month(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = li.groupBy(F.date_trunc("month", "l_shipdate").alias("ship_month"), "l_returnflag").agg(*resample.aggregates({"price": ("vwap", "l_extendedprice", "l_quantity"), "volume": ("sum", "l_quantity")}, []))
    return out.withColumn("price", F.round("price", 4))


def _slots(spark, sf_dir) -> DataFrame:
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 5 + 1).cast("int"))).alias("b"), "o_totalprice")
    grid = o.agg(F.min(F.to_date("a")).alias("x"), F.max(F.to_date("a")).alias("y")).where("x is not null").select(T.spine(F.col("x"), F.col("y"), "1 day").alias("slot"))
    order = [F.desc_nulls_last("o_totalprice"), F.desc("o_orderkey")]
    groups = {"planned": F.col("o_orderpriority").startswith("1"), "forced": ~F.col("o_orderpriority").startswith("1")}
    return intervals.capacity(grid, o, "a", "b", "1 day", "o_custkey", order, F.col("o_orderstatus") != "F", F.col("o_totalprice"), groups)


_SLOTS = """o as (select *, o_orderdate a, o_orderdate + to_days(cast(o_orderkey % 5 + 1 as int)) b from orders),
 g as (select cast(unnest(generate_series((select min(cast(a as date)) from o), (select max(cast(a as date)) from o), interval 1 day)) as date) slot),
 l as (select g.slot, o.* from g join o on o.a < g.slot + interval 1 day and o.b > g.slot qualify row_number() over (partition by g.slot, o_custkey order by o_totalprice desc nulls last, o_orderkey desc) = 1),
 s as (select slot, count(*) n_units, sum(greatest(o_totalprice, 0)) total, sum(greatest(o_totalprice, 0)) filter (where o_orderpriority like '1%') planned, sum(greatest(o_totalprice, 0)) filter (where o_orderpriority not like '1%') forced from l where o_orderstatus <> 'F' group by 1),
 z as (select g.slot, coalesce(n_units, 0) n_units, coalesce(total, 0) total, coalesce(planned, 0) planned, coalesce(forced, 0) forced from g left join s on s.slot = g.slot)"""


@query(f"with {_SLOTS} select slot, n_units, round(total, 2) total, round(planned, 2) planned, round(forced, 2) forced from z")
def outage_slots(spark, sf_dir):
    return _slots(spark, sf_dir).withColumns({c: F.round(c, 2) for c in ("total", "planned", "forced")})


@query(f"with {_SLOTS} select cast(date_trunc('month', slot) as date) month_start, round(avg(total), 4) total_mean, round(max(total), 2) total_peak, max(n_units) units_peak, count(*) slots from z group by 1 having count(*) >= 28")
def outage_rollup(spark, sf_dir):
    out = _slots(spark, sf_dir).groupBy(F.trunc("slot", "month").alias("month_start")).agg(F.round(F.avg("total"), 4).alias("total_mean"), F.round(F.max("total"), 2).alias("total_peak"), F.max("n_units").alias("units_peak"), F.count("*").alias("slots"))
    return out.where("slots >= 28")


@query("select o_custkey, o_orderkey, o_orderstatus, o_orderdate from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_totalprice desc nulls last, o_orderkey desc) = 1")
def latest_version(spark, sf_dir):
    order = [F.desc_nulls_last("o_orderdate"), F.desc_nulls_last("o_totalprice"), F.desc("o_orderkey")]
    return intervals.latest(_t(spark, sf_dir, "orders"), ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")


@query("select o_custkey, o_orderkey, o_totalprice from orders where o_orderdate <= timestamp '1996-06-30 00:00:00' qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def known_at_decision(spark, sf_dir):
    known = intervals.as_known(_t(spark, sf_dir, "orders"), "o_orderdate", F.expr("timestamp_ntz '1996-06-30 00:00:00'"))
    return intervals.latest(known, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""with p as (select distinct cast(o_orderdate as date) as day from orders) select cast(d as date) as day from (select unnest(generate_series((select min(day) from p), (select max(day) from p), interval 1 day)) d) where cast(d as date) not in (select day from p)""")
def date_spine_gaps(spark, sf_dir):
    return checks.missing_dates(_t(spark, sf_dir, "orders"), "o_orderdate")


@query("""with m as (select distinct date_trunc('minute', ts) t from events), r as (select t, t - to_minutes(cast(row_number() over (order by t) as int)) g from m) select min(t) "first", max(t) "last", count(*) n from r group by g""")
def gaps_islands(spark, sf_dir):
    return checks.islands(_t(spark, sf_dir, "events"), "ts", 60)


@query("""with d as (select distinct cast(ts as date) as day, hour(ts) as h from events where event_type = 'purchase'), g as (select distinct day from d)
 select g.day, cast(r.range as int) as hour_no from g cross join range(24) r where not exists (select 1 from d where d.day = g.day and d.h = r.range)""")
def missing_hours(spark, sf_dir):
    e = _t(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour_no"))
    return checks.missing_points(e, "day", "hour_no", 24)


@query("""with a as (select cast(o_orderdate as date) as day, count(*) orders_n from orders group by 1), b as (select cast(l_shipdate as date) as day, count(*) lines_n from lineitem group by 1)
 select coalesce(a.day, b.day) as day, orders_n, lines_n, case when a.day is not null and b.day is not null then 'both' when a.day is not null then 'left' else 'right' end side from a full join b on b.day = a.day""")
def reconcile_full_outer(spark, sf_dir):
    a = _t(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders_n"))
    b = _t(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("lines_n"))
    return checks.reconcile(a, b, ["day"], "orders_n", "lines_n")


@query("""select event_type, min(cast(ts as date)) first_day, max(cast(ts as date)) last_day, count(distinct date_trunc('hour', ts)) actual, (date_diff('day', min(cast(ts as date)), max(cast(ts as date))) + 1) * 24 expected,
 round(100.0 * count(distinct date_trunc('hour', ts)) / ((date_diff('day', min(cast(ts as date)), max(cast(ts as date))) + 1) * 24), 2) "percent" from events group by 1""")
def coverage_pct(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    out = e.groupBy("event_type").agg(F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"), F.count_distinct(F.date_trunc("hour", "ts")).alias("actual"))
    expected = ((F.datediff("last_day", "first_day") + 1) * 24).cast("long")
    return out.withColumn("expected", expected).withColumn("percent", F.round(100.0 * F.col("actual") / F.col("expected"), 2))


@query("""with c as (select event_type, 100.0 * count(distinct date_trunc('hour', ts)) / ((date_diff('day', min(cast(ts as date)), max(cast(ts as date))) + 1) * 24) p from events group by 1)
 select event_type, case when p is null or p = 0 then 'EMPTY' when p >= 99 then 'OK' when p >= 90 then 'WARN' else 'GAPS' end status from c""")
def consistency_status(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    days = F.datediff(F.max(F.to_date("ts")), F.min(F.to_date("ts"))) + 1
    return e.groupBy("event_type").agg(checks.status(100.0 * F.count_distinct(F.date_trunc("hour", "ts")) / (days * 24)).alias("status"))


@query("""select 'orders' table_name, 'o_orderdate' column_name, count(*) "rows", count(*) filter (where o_orderdate is null) nulls from orders union all select 'orders', 'o_totalprice', count(*), count(*) filter (where o_totalprice is null) from orders
 union all select 'customer', 'c_acctbal', count(*), count(*) filter (where c_acctbal is null) from customer union all select 'events', 'value', count(*), count(*) filter (where value is null) from events union all select 'events', 'props', count(*), count(*) filter (where props is null) from events""")
def null_audit_union(spark, sf_dir):
    columns = {"orders": ["o_orderdate", "o_totalprice"], "customer": ["c_acctbal"], "events": ["value", "props"]}
    return checks.null_counts({n: _t(spark, sf_dir, n) for n in columns}, columns)


@query("select event_id, ts, event_type, value from events where (cast(ts as date), event_type) in (select cast(ts as date), event_type from events group by all having max(value) >= 200)")
def row_value_in(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("_d", F.to_date("ts"))
    return e.join(e.groupBy("_d", "event_type").agg(F.max("value").alias("most")).where("most >= 200"), ["_d", "event_type"], "left_semi").select("event_id", "ts", "event_type", "value")


@query("""with r as (select cast(o_orderdate as date) d, max(o_totalprice) / 10000 rate from orders group by 1), z as (select arg_max(rate, d) rate from r)
 select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, cast(l_shipdate as date) as day, round(l_extendedprice / coalesce(r.rate, z.rate), 2) converted from lineitem left join r on r.d = cast(l_shipdate as date) cross join z""")
def fx_convert(spark, sf_dir):
    rates = _t(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg((F.max("o_totalprice") / 10000).alias("rate"))
    newest = rates.agg(F.max_by("rate", "day").alias("_newest"))
    li = _t(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate")).join(rates, "day", "left").crossJoin(F.broadcast(newest))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "day", F.round(F.col("l_extendedprice") / F.coalesce("rate", "_newest"), 2).alias("converted"))


@query("""with r as (select cast(o_orderdate as date) d, max(o_totalprice) rate from orders group by 1), e as (select distinct cast(l_shipdate as date) d from lineitem) select e.d as day, r.rate from e asof left join r on e.d >= r.d""")
def fx_as_of(spark, sf_dir):
    rates = _t(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("rate"))
    days = _t(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return intervals.as_of(days, rates, [], "day", "rate").select("day", "rate")


def _versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The stored version is of the customers with orders; the new one is of all customers, with fees taken from debts."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").withColumn("version", F.lit(1))
    stored = c.join(_t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi")
    return stored, c.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, F.col("c_acctbal") - 1).otherwise(F.col("c_acctbal"))).withColumn("version", F.lit(2))


_VERSIONS = """t as (select c_custkey, c_name, c_acctbal, 1 as version from customer where c_custkey in (select o_custkey from orders)),
 s as (select c_custkey, c_name, case when c_acctbal < 0 then c_acctbal - 1 else c_acctbal end c_acctbal, 2 as version from customer)"""


@query(f"with {_VERSIONS} select * from s union all select * from t where c_custkey not in (select c_custkey from s)")
def upsert_merge(spark, sf_dir):
    t, s = _versions(spark, sf_dir)
    return upsert.merge(t, s, ["c_custkey"])


@query(f"""with {_VERSIONS} select coalesce(s.c_custkey, t.c_custkey) c_custkey, coalesce(s.c_name, t.c_name) c_name, coalesce(s.c_acctbal, t.c_acctbal) c_acctbal, case when t.c_custkey is null or (s.c_custkey is not null and s.c_acctbal is distinct from t.c_acctbal) then 2 else 1 end as version,
 case when t.c_custkey is null then 'inserted' when s.c_custkey is null then 'same' when s.c_acctbal is distinct from t.c_acctbal then 'updated' else 'same' end change from t full join s on s.c_custkey = t.c_custkey""")
def upsert_changed(spark, sf_dir):
    t, s = _versions(spark, sf_dir)
    return upsert.merge_changed(t, s, ["c_custkey"], ["c_name", "c_acctbal"], {"version": F.lit(2)})


@query(f"with {_VERSIONS} select * from t union all select * from s where c_custkey not in (select c_custkey from t)")
def insert_absent(spark, sf_dir):
    t, s = _versions(spark, sf_dir)
    return upsert.insert_absent(t, s, ["c_custkey"])


@query("select event_id, ts, value from events where ts < timestamp '2024-01-10' or ts >= timestamp '2024-01-12' union all select event_id + 1000000, ts, value * 2 from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-12'")
def replace_days(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "ts", "value")
    low, high = F.expr("timestamp_ntz '2024-01-10 00:00:00'"), F.expr("timestamp_ntz '2024-01-12 00:00:00'")
    new = e.where((F.col("ts") >= low) & (F.col("ts") < high)).select((F.col("event_id") + 1000000).alias("event_id"), "ts", (F.col("value") * 2).alias("value"))
    return upsert.replace_range(e, new, "ts", low, high)


@query("with t as (select event_id, ts from events where ts < timestamp '2024-01-15') select * from t union all select event_id, ts from events where ts > (select coalesce(max(ts), timestamp '1970-01-01') from t)")
def hwm_append(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "ts")
    return upsert.append_newer(e.where("ts < timestamp_ntz '2024-01-15 00:00:00'"), e, "ts", F.expr("timestamp_ntz '1970-01-01 00:00:00'"))


@query("with h as (select *, date_trunc('hour', ts) h from events where event_type = 'click') select event_id, ts, round(case when minute(ts) >= 30 then avg(value) over (partition by h) else value end, 6) value_hour from h")
def hour_backfill(spark, sf_dir):
    e = _t(spark, sf_dir, "events").where("event_type = 'click'").withColumn("_h", F.date_trunc("hour", "ts"))
    return resample.hour_mean_back(e, "value", ["_h"], F.minute("ts") >= 30).select("event_id", "ts", F.round("value_hour", 6).alias("value_hour"))


_FINE = "f as (select cast(ts as date) as day, event_type, value, case when event_id % 4 = 0 then 15 else 60 end res, event_id from events), k as (select * from f qualify res = min(res) over (partition by day, event_type))"
_KINDS = ["click", "view", "purchase"]


@query(f"with {_FINE} select day, " + ", ".join(f"round(sum(value) filter (where event_type = '{k}'), 4) \"{k}\"" for k in _KINDS) + " from k group by 1")
def wide_pivot_priority(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "value", F.when(F.col("event_id") % 4 == 0, 15).otherwise(60).alias("res"))
    out = reshape.widen(reshape.finest(e, ["day", "event_type"], "res"), ["day"], "event_type", "value", _KINDS)
    return out.select("day", *[F.round(k, 4).alias(k) for k in _KINDS])


@query(f"with {_FINE} select day, " + ", ".join(f"arg_min(value, event_id) filter (where event_type = '{k}') \"{k}\"" for k in _KINDS) + " from k group by 1")
def wide_pivot_first(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "value", "event_id", F.when(F.col("event_id") % 4 == 0, 15).otherwise(60).alias("res"))
    return reshape.widen(reshape.finest(e, ["day", "event_type"], "res"), ["day"], "event_type", "value", _KINDS, "first", "event_id")


@query("""with p as (select event_type, cast(ts as date) as day, hour(ts) + 1 pos, last(value order by ts, event_id) v from events group by 1, 2, 3), g as (select event_type, day, cast(unnest(range(1, 25)) as int) as position from (select distinct event_type, day from p))
 select g.event_type, g.day, g.position, coalesce(last_value(p.v ignore nulls) over (partition by g.event_type, g.day order by g.position rows unbounded preceding), 0.0) v from g left join p on p.event_type = g.event_type and p.day = g.day and p.pos = g.position""")
def ffill_grid(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    p = e.groupBy("event_type", F.to_date("ts").alias("day"), (F.hour("ts") + 1).alias("position")).agg(stats.last_by("value", "ts", "event_id").alias("v")).withColumn("length", F.lit(24))
    return reshape.fill_forward(p, ["event_type", "day"], "position", "length", ["v"])


@query("""with p as (select cast(ts as date) as day, cast(hour(ts) * 4 + minute(ts) // 15 + 1 as int) as period, round(sum(value), 4) v from events where event_type = 'purchase' group by 1, 2), g as (select day, cast(unnest(range(1, 97)) as int) as period from (select distinct day from p))
 select g.day, g.period, case when p.day is null then 0.0 else p.v end v from g left join p on p.day = g.day and p.period = g.period""")
def densify_zero(spark, sf_dir):
    e = _t(spark, sf_dir, "events").where("event_type = 'purchase'")
    p = e.groupBy(F.to_date("ts").alias("day"), T.period(F.col("ts")).alias("period")).agg(F.round(F.sum("value"), 4).alias("v"))
    return reshape.densify(p, ["day"], ["v"])


@query("""with h as (select date_trunc('hour', ts) hour_start, count(*) volume, max(value) price from events group by 1) select hour_start + to_minutes(cast(q.range * 15 as int)) hour_start, cast(q.range as int) as quarter, volume / 4 volume, price from h cross join range(4) q""")
def upsample_quarters(spark, sf_dir):
    h = _t(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour_start")).agg(F.count("*").alias("volume"), F.max("value").alias("price"))
    up = h.withColumn("quarter", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return up.select((F.col("hour_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("quarter") * 15)).alias("hour_start"), "quarter", (F.col("volume") / 4).alias("volume"), "price")


@query("select user_id, nullif(round(sum(case when event_type = 'click' then 1.0::double else -1.0::double end), 4), 0) net from events group by 1")
def signed_net(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("net", F.lit(1.0))
    return reshape.signed_net(e, ["user_id"], "net", F.col("event_type") == "click")


@query("""with d as (select cast(ts as date) as day, event_id, case when event_id % 5 = 0 then 0.0 else value end v, row_number() over (partition by cast(ts as date) order by ts desc, event_id desc) rn from events) select day, event_id, case when rn = 1 and v = 0 then null else v end v from d""")
def placeholder_null(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "ts", "event_id", F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(F.col("value")).alias("v"))
    return resample.trailing_placeholder(e, "v", "day", ["ts", "event_id"]).select("day", "event_id", "v")


@query("""select event_id, strftime(time_bucket(interval 15 minute, ts), '%H:%M') || '-' || strftime(time_bucket(interval 15 minute, ts) + interval 15 minute, '%H:%M') as quarter,
 strftime(date_trunc('hour', ts), '%H:%M') || '-' || strftime(date_trunc('hour', ts) + interval 1 hour, '%H:%M') hour_interval, cast(hour(ts) * 4 + minute(ts) // 15 + 1 as int) as period from events""")
def interval_strings(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    q = T.label(T.floor_to(F.col("ts"), 15))
    return e.select("event_id", T.canonical_label(T.period_label(T.period(F.col("ts")), "24:00")).alias("quarter"), T.hour_label(q).alias("hour_interval"), T.period(F.col("ts")).alias("period"))


@query("""with c as (select o_orderkey, strftime(o_orderdate, '%Y%m%d') || ' 22:00-' || strftime(o_orderdate + to_days(cast(o_orderkey % 2 as int)), '%Y%m%d') || case when o_orderkey % 2 = 0 then ' 22:15' else ' 00:00' end contract from orders)
 select o_orderkey, contract, strptime(substring(contract, 1, 14), '%Y%m%d %H:%M') "start", strptime(substring(contract, 16), '%Y%m%d %H:%M') "end", cast(date_diff('minute', strptime(substring(contract, 1, 14), '%Y%m%d %H:%M'), strptime(substring(contract, 16), '%Y%m%d %H:%M')) as int) as minutes from c""")
def contract_parse(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    day = lambda c: F.date_format(c, "yyyyMMdd")
    end = F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 2).cast("int"))
    text = F.concat(day("o_orderdate"), F.lit(" 22:00-"), day(end), F.when(F.col("o_orderkey") % 2 == 0, " 22:15").otherwise(" 00:00"))
    return o.select("o_orderkey", text.alias("contract")).withColumn("_c", T.contract(F.col("contract"))).select("o_orderkey", "contract", "_c.start", "_c.end", "_c.minutes")


@query("""select c_custkey, case when c_custkey % 10 = 0 then null else c_acctbal end amount from customer""")
def number_clean(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    text = F.when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.format_number("c_acctbal", 2)))
    return c.select("c_custkey", T.number(text).alias("amount"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events where json_extract_string(props, '$.k') is not null")
def json_extract(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))
    return e.where("k is not null")


@query("""with l as (select (ts at time zone 'UTC') at time zone 'Europe/Prague' local_ts, value from events) select cast(local_ts as date) local_day, cast(hour(local_ts) * 4 + minute(local_ts) // 15 + 1 as int) as period, count(*) n, max(value) peak from l group by 1, 2""")
def tz_bucket(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("_l", T.to_local(F.col("ts")))
    return e.groupBy(F.to_date("_l").alias("local_day"), T.period(F.col("_l")).alias("period")).agg(F.count("*").alias("n"), F.max("value").alias("peak"))


@query("select r_name, n_name, count(*) suppliers, round(sum(s_acctbal), 2) total from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey group by 1, 2")
def area_total(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).join(_t(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return s.groupBy("r_name", "n_name").agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("total"))


@query("select cast(ts as date) trade_date, strftime(time_bucket(interval 15 minute, ts), '%H:%M') || '-' || strftime(time_bucket(interval 15 minute, ts) + interval 15 minute, '%H:%M') time_interval from events where ts >= (select max(ts) from events) - interval 6 hour group by 1, 2")
def touched_intervals(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    mark = e.agg((F.max("ts") - F.expr("interval 6 hours")).alias("_m"))
    return resample.touched_intervals(e.crossJoin(F.broadcast(mark)).where("ts >= _m"), "ts")


@query("select n_regionkey, string_agg(n_name, ', ' order by n_nationkey) names, count(*) n from nation group by 1")
def names_listed(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]), ", ").alias("names"), F.count("*").alias("n"))
    return n.select("n_regionkey", "names", "n")


@query("select user_id, last(value order by ts, event_id) last_value, max(ts) last_ts from events group by 1")
def last_wins(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(stats.last_by("value", "ts", "event_id").alias("last_value"), F.max("ts").alias("last_ts"))


@query("""with p as (select o_custkey, cast(row_number() over (partition by o_custkey order by o_orderkey) as int) as position, o_totalprice quantity from orders), t as (select *, timestamp '2024-03-31' + to_minutes(cast((position - 1) * 15 as int)) "at" from p)
 select o_custkey, position, "at", cast(hour(l) * 4 + minute(l) // 15 + 1 as int) as period, quantity from (select *, ("at" at time zone 'UTC') at time zone 'Europe/Prague' l from t)""")
def xml_curve_points(spark, sf_dir):
    """Customers' orders as curve documents of one series each, parsed back to points."""
    o = _t(spark, sf_dir, "orders").withColumn("_p", F.row_number().over(_by_customer()))
    point = F.concat(F.lit("<Point><position>"), F.col("_p"), F.lit("</position><quantity>"), F.col("o_totalprice"), F.lit("</quantity></Point>"))
    body = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", point.alias("x")))), lambda r: r["x"]), "").alias("points"))
    head = '<Document xmlns="urn:x"><TimeSeries><mRID>1</mRID><businessType>A19</businessType><Period><timeInterval><start>2024-03-31T00:00Z</start><end>2024-04-01T00:00Z</end></timeInterval><resolution>PT15M</resolution>'
    docs = body.select("o_custkey", F.concat(F.lit(head), F.col("points"), F.lit("</Period></TimeSeries></Document>")).alias("text"))
    points = sources.curve_points(docs)
    return points.select("o_custkey", "position", "at", T.period(T.to_local(F.col("at"))).alias("period"), "quantity")


def _by_customer():
    from pyspark.sql import Window

    return Window.partitionBy("o_custkey").orderBy("o_orderkey")
