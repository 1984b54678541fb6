"""The market pipelines and document parsers on the driver's tables, each with SQL that says the same.

As in the catalogue, tables stand in for market tables: event types are areas, events minute data
or documents' points, and an order with its lines is one document.
"""

from __future__ import annotations

import io
import itertools
import operator
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions import stats
from tidewatt.functions import timegrid as T
from tidewatt.operators import checks, intervals, ledger, quantiles, resample, reshape, upsert
from tidewatt.plans import market
from tidewatt.plans.catalogue import QUERIES, SQL, _t, query
from tidewatt.scratch import scratch
from tidewatt.sources import archives, arrivals, sheets
from tidewatt.sources import documents as sources
from tidewatt.streaming import live

#: Bytes at which a batch of files that were made goes back to Spark.
FILES = 1 << 20

_LABEL = "strftime(time_bucket(interval 15 minute, {0}), '%H:%M') || '-' || strftime(time_bucket(interval 15 minute, {0}) + interval 15 minute, '%H:%M')"
_LOCAL = "(({0} at time zone 'UTC') at time zone 'Europe/Prague')"
_HOUR = "substring(time_interval, 1, 2) || ':00-' || lpad(cast((cast(substring(time_interval, 1, 2) as int) + 1) % 24 as varchar), 2, '0') || ':00'"


def _rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema if f.dataType.typeName() == "double"})


# Hourly roll-ups. The k-th column of a table's quarters is the quarter's mean value plus k.


def _inputs(table: str) -> list[str]:
    return sorted({c for _, *cs in market.ROLL_UPS[table][1].values() for c in cs})


def _roll_up_sql(table: str) -> str:
    keys, rules = market.ROLL_UPS[table]
    at = {c: f"(v + {k})" for k, c in enumerate(_inputs(table))}
    said = {
        "mean": lambda c: f"round(avg({at[c]}), 8)", "sum": lambda c: f"round(sum({at[c]}), 8)", "max": lambda c: f"round(max({at[c]}), 8)", "any": lambda c: f"round(max({at[c]}), 8)",
        "last": lambda c: f"round(last({at[c]} order by time_interval), 8)", "vwap": lambda p, v: f"round(sum({at[p]} * {at[v]}) / sum({at[v]}), 8)",
    }
    area = "event_type" if keys else "'all'"
    quarters = f"q as (select {area} area, cast(ts as date) trade_date, {_LABEL.format('ts')} time_interval, avg(value) v from events group by all)"
    columns = [*[f'area "{k}"' for k in keys], "trade_date", f"{_HOUR} time_interval", *[f'{said[rule](*cs)} "{name}"' for name, (rule, *cs) in rules.items()]]
    return f"with {quarters} select {', '.join(columns)} from q group by area, trade_date, {_HOUR} having count(distinct q.time_interval) = 4"


def _add_roll_up(table: str) -> None:
    def roll_up(spark, sf_dir):
        keys, _ = market.ROLL_UPS[table]
        start = T.floor_to(F.col("ts"), 15)
        area = [F.col("event_type").alias("area")] if keys else []
        q = _t(spark, sf_dir, "events").groupBy(*area, start.alias("start")).agg(F.avg("value").alias("v"))
        quarters = q.select(*[F.col("area").alias(k) for k in keys], F.to_date("start").alias("trade_date"), T.label(F.col("start")).alias("time_interval"), *[(F.col("v") + k).alias(c) for k, c in enumerate(_inputs(table))])
        return _rounded(market.hourly(table, quarters))

    QUERIES[f"hourly_{table}"], SQL[f"hourly_{table}"] = roll_up, _roll_up_sql(table)


for _table in market.ROLL_UPS:
    _add_roll_up(_table)


# Minute tables.

_MINUTES = {"afrr_plus_mw": "click", "afrr_minus_mw": "view", "price_mfrr_5_eur_mwh": "purchase"}
_MINUTE_SQL = "m as (select date_trunc('minute', ts) tm, " + ", ".join(f"avg(value) filter (where event_type = '{k}') {c}" for c, k in _MINUTES.items()) + " from events group by 1)"


def _stats_sql() -> str:
    said = {"mean": "avg({0})", "median": "median({0})", "last": "last({0} order by tm)"}
    columns = [f"round({sql.format(c)}, 8) {market.stat_name(c, s)}" for c in _MINUTES for s, sql in said.items()]
    return f"with {_MINUTE_SQL} select cast(tm as date) trade_date, {_LABEL.format('tm')} time_interval, {', '.join(columns)} from m group by time_bucket(interval 15 minute, tm), 1, 2"


def _minutes(spark, sf_dir, kinds: dict[str, str], at: str) -> DataFrame:
    values = [F.avg(F.when(F.col("event_type") == kind, F.col("value"))).alias(c) for c, kind in kinds.items()]
    return _t(spark, sf_dir, "events").groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias(at)).agg(*values)


@query(_stats_sql())
def minute_statistics(spark, sf_dir):
    return _rounded(market.minute_statistics(_minutes(spark, sf_dir, _MINUTES, "delivery_timestamp"), list(_MINUTES)))


_KINDS = {"afrr_plus": "click", "afrr_minus": "view", "mfrr_plus": "purchase", "mfrr_minus": "click"}


def _features_sql() -> str:
    base = f"""h as (select time_bucket(interval 15 minute, tm) b, cast(tm as date) d, minute(tm) % 15 mi, afrr_plus_mw a, afrr_minus_mw v, price_mfrr_5_eur_mwh p from m), l as (select d, quantile_cont(abs(v), 0.95) lim from h group by 1),
 j as (select h.*, coalesce(abs(v) >= coalesce(lim, 999999) * 0.95, false) s from h join l on l.d = h.d)"""
    columns = []
    for side, kind in _KINDS.items():
        x = {"click": "a", "view": "v", "purchase": "p"}[kind]
        columns += [f"min({x}) {side}_min_eur", f"max({x}) {side}_max_eur", f"round(stddev_samp({x}), 4) {side}_std_eur", f"round(case when count({x}) >= 3 and stddev_pop({x}) > 0 then skewness({x}) end, 4) {side}_skew"]
    columns += [
        "round(max(v) - min(v), 6) imbalance_range_mw", "round(stddev_samp(v), 4) imbalance_std_mw", "round(regr_slope(v, mi), 4) imbalance_slope", "count(*) filter (where v <= -500) minutes_at_floor",
        "count(*) filter (where a >= 500) minutes_near_peak", "count(*) filter (where s) saturation_count", "round(avg(a + p), 6) total_active_mean_mw", "round(stddev_samp(a + p), 4) total_active_std_mw",
        "count(*) filter (where v <> 0 or p <> 0) platform_active_count", "round(avg(a - p), 6) afrr_mfrr_plus_spread_mean_eur", "round(stddev_samp(a - p), 4) afrr_mfrr_plus_spread_std_eur",
        "round(avg(v - a), 6) afrr_mfrr_minus_spread_mean_eur", "round(stddev_samp(v - a), 4) afrr_mfrr_minus_spread_std_eur",
    ]
    gated = [f"case when count(*) >= 12 then {c.rsplit(' ', 1)[0]} end {c.rsplit(' ', 1)[1]}" for c in columns]
    return f"with {_MINUTE_SQL}, {base} select d trade_date, {_LABEL.format('b')} time_interval, count(*) minute_count, {', '.join(gated)} from j group by b, d"


@query(_features_sql())
def minute_features_all(spark, sf_dir):
    """All 29 features, behind the gate of 12 minutes."""
    ts = "delivery_timestamp"
    prices = _minutes(spark, sf_dir, {f"price_{side}_eur_mwh": kind for side, kind in _KINDS.items()}, ts)
    imbalance = _minutes(spark, sf_dir, {"system_imbalance_mw": "view"}, ts)
    exchange = _minutes(spark, sf_dir, {"picasso_afrr_mw": "view", "mari_mfrr_mw": "purchase"}, ts)
    activation = _minutes(spark, sf_dir, {"afrr_plus_mw": "click", "mfrr_plus_mw": "purchase"}, ts)
    out = market.minute_features(prices, imbalance, exchange, activation)
    return out.withColumns({f.name: F.round(f.name, 4 if f.name.endswith(("_std_eur", "_std_mw", "_skew", "_slope")) else 6) for f in out.schema if f.dataType.typeName() == "double"})


def _quarters_of(spark, sf_dir, kind: str, **values: Column) -> DataFrame:
    q = _t(spark, sf_dir, "events").where(F.col("event_type") == kind).groupBy(T.floor_to(F.col("ts"), 15).alias("b")).agg(F.avg("value").alias("v"))
    return q.select(F.to_date("b").alias("trade_date"), T.label(F.col("b")).alias("time_interval"), *[c.alias(n) for n, c in values.items()])


@query(f"""with q as (select event_type k, cast(ts as date) trade_date, {_LABEL.format('ts')} time_interval, avg(value) v from events group by all), i as (select * from q where k = 'click')
 select i.trade_date, i.time_interval, round(avg(i.v) over (order by i.trade_date, i.time_interval rows 7 preceding), 8) imb_roll_2h, round(avg(i.v) over w, 8) imb_roll_4h, round(sum(i.v) over w, 8) imb_integral_4h,
 round(g.v - f.v, 8) solar_error_mw, cast(null as double) wind_error_mw, round(g.v + 1 - p.v, 8) gen_total_error_mw
 from i left join q g on g.k = 'view' and g.trade_date = i.trade_date and g.time_interval = i.time_interval left join q f on f.k = 'purchase' and f.trade_date = i.trade_date and f.time_interval = i.time_interval
 left join q p on p.k = 'click' and p.trade_date = i.trade_date and p.time_interval = i.time_interval window w as (order by i.trade_date, i.time_interval rows 15 preceding)""")
def derived_features(spark, sf_dir):
    """The memory of the imbalance, and generation against forecast and plan."""
    v = F.col("v")
    none = F.lit(None).cast("double")
    imbalance = _quarters_of(spark, sf_dir, "click", system_imbalance_mean_mw=v)
    generation = _quarters_of(spark, sf_dir, "view", **{c: {"pvpp_mw": v, "npp_mw": F.lit(1.0)}.get(c, none) for c in market.SOURCES})
    forecast = _quarters_of(spark, sf_dir, "purchase", forecast_solar_mw=v, country_code=F.lit("CZ"))
    return _rounded(market.derived_features(imbalance, generation, _quarters_of(spark, sf_dir, "click", total_mw=v), forecast))


# Documents' points on the local grid.

_PSR = {"click": "B16", "view": "B18", "purchase": "B19", "signup": "B02", "error": "B05"}
_POINTS = f"""p as (select event_id doc, event_type, user_id, value, case when event_id % 4 = 0 then 60 else 15 end res, cast({_LOCAL.format('b')} as date) trade_date, cast(hour({_LOCAL.format('b')}) * 4 + minute({_LOCAL.format('b')}) // 15 + 1 as int) "period", false fold, 'A' || (user_id % 2) country_code
 from (select *, time_bucket(interval 15 minute, ts) b from events))"""
_AT = 'country_code, trade_date, "period"'


def _points(spark, sf_dir) -> DataFrame:
    start = T.floor_to(F.col("ts").cast("timestamp_ntz"), 15)
    e = _t(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("doc"), F.lit(0).alias("series"), F.lit(0).alias("part"), F.lit(1).alias("position"), F.lit(1).alias("length"), start.alias("period_start"), start.alias("at"),
        F.when(F.col("event_id") % 4 == 0, 60).otherwise(15).alias("resolution"), F.concat(F.lit("A"), (F.col("user_id") % 2).cast("string")).alias("country_code"), F.col("value").alias("quantity"), F.col("value").alias("price"),
        "event_type", "user_id", reshape.mapped(F.col("event_type"), _PSR).alias("psr_type"),
    )


@query(f"""with {_POINTS}, a as (select {_AT}, last(value order by doc) v from p where event_type = 'click' group by all), f as (select {_AT}, last(value order by doc) v from p where event_type = 'view' group by all)
 select {_AT}, a.v actual_load_mw, f.v forecast_load_mw from a full join f using ({_AT})""")
def document_load(spark, sf_dir):
    p = _points(spark, sf_dir)
    return market.load(p.where("event_type = 'click'"), p.where("event_type = 'view'"))


_WIND = f"""w as (select {_AT}, event_type, last(value order by doc) v from (select * from p where event_type in ('view', 'purchase') qualify res = min(res) over (partition by {_AT}, event_type)) group by all)"""


@query(f"""with {_POINTS}, {_WIND} select {_AT}, max(v) filter (where event_type = 'purchase') wind_onshore_mw, max(v) filter (where event_type = 'view') wind_offshore_mw, round(sum(v), 6) wind_total_mw from w group by all""")
def document_wind(spark, sf_dir):
    return market.wind(_points(spark, sf_dir)).withColumn("wind_total_mw", F.round("wind_total_mw", 6))


@query(f"""with {_POINTS} select {_AT}, fold, last(value order by doc) filter (where event_type = 'click') up, last(value order by doc) filter (where event_type = 'view') down from p where event_type in ('click', 'view') group by all""")
def document_balancing(spark, sf_dir):
    p = _points(spark, sf_dir).withColumns({"business_type": F.lit("A95"), "direction": reshape.mapped(F.col("event_type"), {"click": "A01", "view": "A02"})})
    return market.balancing_energy(p, {("A95", "A01"): "up", ("A95", "A02"): "down"})


@query(f"""with {_POINTS} select {_AT}, fold, last(value order by doc) filter (where doc % 3 <> 0) price from p group by all""")
def document_day_ahead(spark, sf_dir):
    return market.day_ahead_prices(_points(spark, sf_dir).withColumn("price", F.when(F.col("doc") % 3 != 0, F.col("price"))))


@query(f"""with {_POINTS}, a as (select {_AT}, fold, coalesce(last(value order by doc) filter (where event_type = 'click'), 0) pos, coalesce(last(value order by doc) filter (where event_type = 'view'), 0) neg from p where event_type in ('click', 'view') group by all),
 v as (select {_AT}, fold, last(value order by doc) q, last(user_id order by doc) u from p where event_type = 'purchase' group by all)
 select {_AT}, fold, coalesce(pos, 0) pos_imb_price_mwh, 0.0::double pos_imb_scarcity_mwh, coalesce(pos, 0) * 2 pos_imb_incentive_mwh, 0.0::double pos_imb_financial_neutrality_mwh, coalesce(neg, 0) neg_imb_price_mwh, 0.0::double neg_imb_scarcity_mwh,
 coalesce(neg, 0) * 2 neg_imb_incentive_mwh, 0.0::double neg_imb_financial_neutrality_mwh, coalesce(q, 0) imbalance_mwh, q / 2 difference_mwh, case when u is null then 'surplus' when u % 2 = 0 then 'deficit' else 'balanced' end situation from a full join v using ({_AT}, fold)""")
def document_imbalance(spark, sf_dir):
    """Prices with one part, and volumes with their situation, by area."""
    p = _points(spark, sf_dir)
    prices = p.where("event_type in ('click', 'view')").withColumns({"category": reshape.mapped(F.col("event_type"), {"click": "A04", "view": "A05"}), "incentive": F.col("price") * 2})
    volumes = p.where("event_type = 'purchase'").withColumns({"difference": F.col("quantity") / 2, "direction": F.when(F.col("user_id") % 2 == 0, "A02").otherwise("A03")})
    return market.imbalance_prices(prices, volumes)


_COLUMN = "case event_type when 'click' then 'solar' when 'view' then 'wind_offshore' when 'purchase' then 'wind' else 'coal' end"
_PLANTS = {"B16": "solar", "B18": "wind_offshore", "B19": "wind", "B02": "coal", "B05": "coal"}
_FINEST = f"{_POINTS}, k as (select *, {_COLUMN} kind from p), f as (select * from k qualify res = min(res) over (partition by {_AT}, kind))"
_KINDS_OF = ("coal", "solar", "wind", "wind_offshore")


@query(f"with {_FINEST} select {_AT}, " + ", ".join(f"round(sum(value) filter (where kind = '{k}'), 6) gen_{k}_mw" for k in _KINDS_OF) + " from f group by all")
def document_generation(spark, sf_dir):
    """Of each kind the finest resolution counts, and its series are summed."""
    return _rounded(market.generation(_points(spark, sf_dir), _PLANTS), 6)


@query(f"with {_FINEST} select {_AT}, " + ", ".join(f"first(value order by doc) filter (where kind = '{k}') gen_{k}_mw" for k in _KINDS_OF) + " from f group by all")
def document_generation_forecast(spark, sf_dir):
    """Of each kind the first series of the finest resolution counts."""
    return market.generation(_points(spark, sf_dir), _PLANTS, "first")


_FLOWS = f"{_POINTS}, b as (select *, case when event_type in ('click', 'view') then 'de' else 'at' end border, case when doc % 3 = 0 then floor(value) else -floor(value) end flow from p where event_type in ('click', 'view', 'purchase'))"


def _flow_points(spark, sf_dir) -> DataFrame:
    """Flows over two borders, into CZ each third one; those of other events are of a border that is none."""
    p = _points(spark, sf_dir).withColumn("quantity", F.floor("quantity").cast("double"))
    other = F.when(F.col("event_type").isin("click", "view"), "DE").when(F.col("event_type") == "purchase", "AT").otherwise("XX")
    into = F.col("doc") % 3 == 0
    return p.withColumns({"in_domain": F.when(into, "CZ").otherwise(other), "out_domain": F.when(into, other).otherwise("CZ")})


@query(f"""with {_FLOWS}, f as (select * from b qualify res = min(res) over (partition by {_AT}, border)), w as (select {_AT}, fold, last(flow order by doc) filter (where border = 'at') a, last(flow order by doc) filter (where border = 'de') d from f group by all)
 select {_AT}, fold, a flow_at_mw, d flow_de_mw, coalesce(a, 0) + coalesce(d, 0) flow_total_net_mw from w""")
def document_flows(spark, sf_dir):
    return market.flows(_flow_points(spark, sf_dir), "CZ", {"DE": "de", "AT": "at"})


@query(f"""with {_FLOWS} select {_AT}, fold, nullif(sum(flow) filter (where border = 'at'), 0) exchange_at_mw, nullif(sum(flow) filter (where border = 'de'), 0) exchange_de_mw from b group by all""")
def document_scheduled_exchanges(spark, sf_dir):
    return market.scheduled_exchanges(_flow_points(spark, sf_dir), "CZ", {"DE": "de", "AT": "at"})


@query(f"""with {_POINTS} select {_AT}, fold, nullif(sum(floor(value / 50)), 0) scheduled_mw from p group by all""")
def document_scheduled_generation(spark, sf_dir):
    """All series are summed, and nothing is null."""
    return market.scheduled_generation(_points(spark, sf_dir).withColumn("quantity", F.floor(F.col("quantity") / 50).cast("double")))


@query(f"""with {_POINTS}, a as (select {_AT}, fold, last(case when doc % 4 = 1 then 'A02' else 'A01' end order by doc) st from p where event_type in ('click', 'view') group by all), v as (select distinct {_AT}, fold from p where event_type = 'purchase'),
 c as (select country_code, last(case when doc % 2 = 0 then 'CZK' else 'PLN' end order by doc) cur from p where event_type in ('click', 'view') and doc % 5 = 0 group by 1)
 select {_AT}, fold, coalesce(st, 'A01') status, coalesce(cur, 'EUR') currency from a full join v using ({_AT}, fold) left join c using (country_code)""")
def document_imbalance_status(spark, sf_dir):
    """The documents' status, and the currency of each area's last one that names it."""
    p = _points(spark, sf_dir)
    doc = F.col("doc")
    prices = p.where("event_type in ('click', 'view')").withColumns({"category": F.lit("A04"), "doc_status": F.when(doc % 4 == 1, "A02").otherwise("A01"), "currency": F.when(doc % 5 == 0, F.when(doc % 2 == 0, "CZK").otherwise("PLN"))})
    volumes = p.where("event_type = 'purchase'").withColumns({"difference": F.col("quantity"), "direction": F.lit("A01")})
    return market.imbalance_prices(prices, volumes).select("country_code", "trade_date", "period", "fold", "status", "currency")


@query(f"""with q as (select event_type area, cast(ts as date) trade_date, {_LABEL.format('ts')} time_interval, avg(value) v, min(ts) d from events group by all)
 select area area_id, area country_code, trade_date, {_HOUR} time_interval, round(avg(v), 8) price_eur_mwh, date_trunc('hour', min(d)) delivery_datetime from q group by area, trade_date, {_HOUR} having count(distinct q.time_interval) = 4""")
def hourly_delivery_times(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    q = e.groupBy("event_type", T.floor_to(F.col("ts"), 15).alias("start")).agg(F.avg("value").alias("price_eur_mwh"), F.min("ts").alias("delivery_datetime"))
    area = F.col("event_type")
    return _rounded(market.hourly("day_ahead_prices", q.select(area.alias("area_id"), area.alias("country_code"), F.to_date("start").alias("trade_date"), T.label(F.col("start")).alias("time_interval"), "price_eur_mwh", "delivery_datetime")))


# Documents of text, from tables and back.


def _joined(order: str, text: Column) -> Column:
    """Texts of a group, which is one document's rows, in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("x")))), lambda r: r["x"]), "")


def _line_docs(spark, sf_dir, item: Column, head: str = "<D>", tail: str = "</D>") -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(_joined("l_linenumber", item).alias("x")).select("l_orderkey", F.concat(F.lit(head), "x", F.lit(tail)).alias("text"))


def _tag(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


_COMMENT = "<!-- <{0}/> stands no more -->"


@query("select l_orderkey, l_shipdate + interval 7 minute \"at\", l_quantity value1, case when l_linenumber % 3 <> 0 then l_extendedprice end value2, 'a & ' || l_returnflag \"name\" from lineitem where l_linenumber <> 5")
def xml_attribute_rows(spark, sf_dir):
    """Lines as elements in either quotes, with entities, comments and attributes of like names beside them."""
    day = F.when(F.col("l_linenumber") == 5, "no date").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T00:07:00+01:00'"))
    value = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_extendedprice").cast("string")).otherwise("-")
    quote = F.when(F.col("l_linenumber") % 2 == 0, "'").otherwise('"')
    said = lambda name, v: F.concat(F.lit(f" {name}="), quote, v, quote)
    item = F.concat(F.lit("<item"), said("data-value1", F.lit("7")), said("date", day), said("name", F.concat(F.lit("a &amp; "), "l_returnflag")), said("value1", F.col("l_quantity").cast("string")), said("value2", value), F.lit("><![CDATA[<item/>]]></item>"), F.lit(_COMMENT.format("item date='2024-01-01T00:00:00' value1='9'")))
    return sources.attribute_rows(_line_docs(spark, sf_dir, item, '<x:D xmlns:x="urn:d">', "</x:D>"), "item", 2, ("name",))


@query("""select cast(l_shipdate as date) delivery_date, cast(case when l_linenumber % 2 = 0 then (l_linenumber - 1) * 4 + q.range else l_linenumber end as int) "period", case when l_linestatus = 'O' then 'sell' else 'buy' end side, l_extendedprice price, l_quantity volume_bid, l_tax volume_matched, case when l_linenumber % 2 = 0 then '60min' else '15min' end order_resolution
 from lineitem join range(1, 5) q on l_linenumber % 2 = 0 or q.range = 1""")
def xml_bids(spark, sf_dir):
    """Lines as bids: quarters by children, hours with half of their values as attributes, both around comments."""
    hourly = F.col("l_linenumber") % 2 == 0
    n = F.col("l_linenumber").cast("string")
    side = F.when(F.col("l_linestatus") == "O", "S").otherwise("B")
    rest = F.concat(_tag("price", F.col("l_extendedprice").cast("string")), F.lit(_COMMENT.format("price")), _tag("energy_order", F.col("l_quantity").cast("string")), _tag("energy_match", F.concat(F.lit("<![CDATA["), F.col("l_tax").cast("string"), F.lit("]]>"))))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    item = F.when(hourly, F.concat(F.lit("<data hour='"), n, F.lit("' trade_type='"), side, F.lit("' date='"), day, F.lit("'>"), rest, F.lit("</data>")))
    item = item.otherwise(_tag("data", F.concat(_tag("date", day), F.lit("<period>"), F.lit(_COMMENT.format("period")), n, F.lit("</period>"), _tag("trade_type", side), rest)))
    return sources.bids(_line_docs(spark, sf_dir, item))


@query("select cast(l_orderkey as varchar) k, cast(l_linenumber as varchar) line, case when l_linenumber <> 2 then l_returnflag || ' & <b>' end flag from lineitem")
def xml_column_rows(spark, sf_dir):
    cell = lambda k, v: F.concat(F.lit(f"<Column type='t' id='{k}'>"), v, F.lit("</Column>"))
    flag = cell("c", F.concat(F.col("l_returnflag"), F.lit(" &amp; <![CDATA[<b>]]>")))
    item = _tag("Row", F.concat(cell("a", F.col("l_orderkey").cast("string")), F.lit(_COMMENT.format('Column id="b"')), cell("b", F.col("l_linenumber").cast("string")), F.when(F.col("l_linenumber") != 2, flag).otherwise("")))
    return sources.column_rows(_line_docs(spark, sf_dir, item), {"a": "k", "b": "line", "c": "flag"})


@query("""select l_orderkey, l_shipdate "at", l_quantity temperature, l_tax wind from lineitem""")
def json_columnar(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm").alias("time"), "l_quantity", "l_tax"))).alias("r"))
    part = lambda c, name: F.transform("r", lambda x: x[c]).alias(name)
    docs = li.select("l_orderkey", F.to_json(F.struct(F.struct(part("time", "time"), part("l_quantity", "temperature"), part("l_tax", "wind")).alias("hourly"))).alias("text"))
    return sources.columnar_json(docs, "hourly", ["temperature", "wind"])


@query("""select o_orderkey, o_orderdate "at", o_totalprice temperature from orders""")
def json_current(spark, sf_dir):
    now = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("time"), F.col("o_totalprice").alias("temperature"))
    docs = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(now.alias("current"))).alias("text"))
    return sources.current_json(docs, "current", ["temperature"])


@query("select o_orderkey, case when o_orderkey % 3 <> 0 then o_totalprice end rate from orders")
def json_rates(spark, sf_dir):
    entry = lambda code, amount, rate: F.struct(code.alias("currencyCode"), F.lit(amount).alias("amount"), rate.alias("rate"))
    code = F.when(F.col("o_orderkey") % 3 != 0, "EUR").otherwise("USD")
    rates = F.array(entry(F.lit("EUR"), 100, F.lit(1.0)), entry(code, 1, F.col("o_totalprice")))
    docs = _t(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(rates.alias("rates"))).alias("text"))
    return docs.select("o_orderkey", sources.rate(F.col("text")).alias("rate"))


def _outage_docs(lines: DataFrame, *beside: str) -> DataFrame:
    """An order as the document of an outage, with its lines as points; beside are columns that its lines share."""
    start = F.min("l_shipdate")
    at = lambda c, minutes, form: F.date_format(c + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)), form)
    point = _tag("Point", F.concat(_tag("position", F.col("l_linenumber").cast("string")), _tag("quantity", F.col("l_quantity").cast("string"))))
    li = lines.groupBy(*beside, "l_orderkey").agg(_joined("l_linenumber", point).alias("x"), start.alias("a"))
    a = F.col("a")
    day, clock, instant = "yyyy-MM-dd", "HH:mm'Z'", "yyyy-MM-dd'T'HH:mm'Z'"
    period = _tag("Available_Period", F.concat(_tag("timeInterval", F.concat(_tag("start", at(a, 0, instant)), _tag("end", at(a, 30, instant)))), _tag("resolution", F.lit("PT15M")), "x"))
    series = F.concat(
        _tag("mRID", F.lit("1")), _tag("start_DateAndOrTime.date", at(a, 0, day)), _tag("start_DateAndOrTime.time", at(a, 0, clock)), _tag("end_DateAndOrTime.date", at(a, 120, day)), _tag("end_DateAndOrTime.time", at(a, 120, clock)),
        _tag("production_RegisteredResource.pSRType.powerSystemResources.nominalP", F.lit("100")), period,
    )
    status = F.when(F.col("l_orderkey") % 2 == 0, _tag("docStatus", _tag("value", F.lit("A09")))).otherwise("")
    reason = _tag("Reason", F.concat(_tag("code", F.lit("B95")), _tag("text", F.lit("x"))))
    return li.select(*beside, "l_orderkey", F.concat(F.lit('<D xmlns="urn:o">'), _tag("revisionNumber", (F.col("l_orderkey") % 4).cast("string")), status, reason, _tag("TimeSeries", series), F.lit("</D>")).alias("text"))


@query("""with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber) rn from lineitem) select l_orderkey, cast(l_orderkey % 4 as int) revision_number, case when l_orderkey % 2 = 0 then 'A09' else 'A05' end doc_status, 'B95' reason_code, min(l_shipdate) unavail_start, min(l_shipdate) + interval 2 hour unavail_end,
 100.0::double nominal_mw, min(l_quantity) min_available_mw, 100 - min(l_quantity) max_unavailable_mw, count(*) points, min(l_shipdate) + interval 30 minute point_end from l group by l_orderkey""")
def xml_outages(spark, sf_dir):
    """An order as an outage with its lines as points."""
    return _outages(_outage_docs(_t(spark, sf_dir, "lineitem")))


def _outages(docs: DataFrame) -> DataFrame:
    o = sources.outages(docs)
    return o.select("l_orderkey", "revision_number", "doc_status", "reason_code", "unavail_start", "unavail_end", "nominal_mw", "min_available_mw", "max_unavailable_mw", F.size("points").cast("long").alias("points"), F.col("points")[0]["point_end"].alias("point_end"))


# Outages of plants, settlement, ticks, and writes.


@query("""with o as (select *, o_orderdate a, o_orderdate + to_hours(cast(o_orderkey % 5 + 1 as int)) b from orders where o_orderstatus <> 'F'),
 g as (select cast(unnest(generate_series((select min(o_orderdate) from orders), (select max(o_orderdate) from orders), interval 1 hour)) as timestamp) slot),
 l as (select date_trunc('hour', a) + to_hours(cast(h.range as int)) slot, o.* from o join range(0, 7) h on date_trunc('hour', a) + to_hours(cast(h.range as int)) < b),
 d as (select * from l qualify row_number() over (partition by slot, o_custkey order by o_orderkey % 3 desc, o_totalprice desc, o_orderkey) = 1),
 s as (select slot, count(*) plants, sum(o_totalprice) total_mw, sum(o_totalprice) filter (where o_orderpriority = '1-URGENT') urgent_mw from d group by 1)
 select g.slot, coalesce(plants, 0) plants, round(coalesce(total_mw, 0), 4) total_mw, round(urgent_mw, 4) urgent_mw from g left join s on s.slot = g.slot""")
def plant_outages(spark, sf_dir):
    """Orders as outages of the customers' plants, by priority as fuel."""
    out = market.plant_outages(*_plant_events(spark, sf_dir))
    return out.select("slot", "plants", F.round("total_mw", 4).alias("total_mw"), F.round(F.try_element_at("by_fuel", F.lit("1-URGENT")), 4).alias("urgent_mw"))


def _plant_events(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    events = o.select(F.col("o_custkey").alias("plant"), F.col("o_orderpriority").alias("fuel"), (F.col("o_orderstatus") != "F").alias("active"), (F.col("o_orderkey") % 3).alias("revision"), F.col("o_totalprice").alias("unavailable_mw"), start.alias("start"), (start + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 5 + 1).cast("int"))).alias("end"), F.col("o_orderkey").alias("id"))
    hours = o.agg(F.min(start).alias("x"), F.max(start).alias("y")).where("x is not null").select(T.spine(F.col("x"), F.col("y"), "1 hour").alias("slot"))
    return hours, events


_HOURS = SQL["plant_outages"].split("),\n s as (select slot, count(*) plants")[0] + ")"


@query(f"""{_HOURS}, s as (select slot, string_agg(cast(o_custkey as varchar) || ':' || cast(round_even(o_totalprice, 0) as bigint), ', ' order by o_totalprice desc, cast(o_custkey as varchar)) listed from d group by 1)
 select g.slot, coalesce(listed, '') listed from g left join s on s.slot = g.slot""")
def plant_names(spark, sf_dir):
    """The plants that are out in each hour, largest first."""
    hours, events = _plant_events(spark, sf_dir)
    return market.plant_outages(hours, events, names=True).select("slot", "listed")


_PRICED = f"""c as (select event_id, time_bucket(interval 15 minute, ts) a, case when event_id % 3 = 0 then 60 else 15 end mi from events), q as (select time_bucket(interval 15 minute, ts) b, round(avg(value), 6) price from events where event_type = 'click' group by 1), h as (select date_trunc('hour', ts) b, round(avg(value), 6) price from events where event_type = 'click' group by 1)"""


@query(f"""with {_PRICED} select event_id, strftime(a, '%Y%m%d %H:%M') || '-' || strftime(a + to_minutes(mi), '%Y%m%d %H:%M') contract, cast(a as date) trade_date, strftime(a, '%H:%M') || '-' || strftime(a + to_minutes(mi), '%H:%M') time_interval, case when mi = 15 then q.price else h.price end price
 from c left join q on q.b = a left join h on h.b = a""")
def price_by_duration(spark, sf_dir):
    """Contracts of a quarter or an hour from the start of each event's quarter; hours that start off the hour have no price."""
    e = _t(spark, sf_dir, "events").withColumn("_a", T.floor_to(F.col("ts"), 15))
    minutes = F.when(F.col("event_id") % 3 == 0, 60).otherwise(15)
    text = lambda c: F.date_format(c, "yyyyMMdd HH:mm")
    contracts = e.select("event_id", F.concat(text("_a"), F.lit("-"), text(F.col("_a") + F.make_dt_interval(F.lit(0), F.lit(0), minutes))).alias("contract"))
    clicks = e.where("event_type = 'click'")
    table = lambda start, m: clicks.groupBy(start.alias("b")).agg(F.round(F.avg("value"), 6).alias("price")).select(F.to_date("b").alias("trade_date"), T.label(F.col("b"), m).alias("time_interval"), "price")
    return market.settlement_prices(contracts, "contract", {15: table(F.col("_a"), 15), 60: table(F.date_trunc("hour", "ts"), 60)}, "price")


@query("""with k as (select *, row_number() over (partition by cast(l_shipdate as date) order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 i from lineitem where l_linenumber <> 4)
 select cast(l_shipdate as date) as day, cast(strftime(l_shipdate, '%Y%m%d') as bigint) * 100000 + i trade_id, 15 contract_duration, l_quantity qty_mw, case when l_returnflag <> 'N' then l_extendedprice end price_eur_mwh, case when l_linenumber = 1 then cast(l_shipdate as date) + interval 9 hour else cast(l_shipdate as date) + interval 0 hour end exec_time
 from k where l_linenumber <> 3""")
def trade_ticks(spark, sf_dir):
    """Lines as a day's sheet rows: each fourth cancelled, each third with an unreadable contract."""
    li = _t(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    n = F.col("l_linenumber")
    d = F.date_format("day", "yyyyMMdd")
    rows = li.select(
        "day", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("at"), F.when(n == 3, "Kontrakt").otherwise(F.concat(d, F.lit(" 10:00-"), d, F.lit(" 10:15"))).alias("contract"), F.when(n == 4, "SN").otherwise(F.col("l_quantity").cast("string")).alias("qty_mw"),
        F.lit("1.5").alias("qty_mwh"), F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice").cast("string")).otherwise("SN").alias("price_eur_mwh"), F.when(n == 1, F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(" 09:00:00"))).otherwise("later").alias("exec_time"),
    )
    return market.trade_ticks(rows, ["day"], "at", F.col("day")).select("day", "trade_id", "contract_duration", "qty_mw", "price_eur_mwh", "exec_time")


@query("""select c_custkey, 'customer_' || c_custkey k from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'O' and o_orderdate > (select max(o_orderdate) from orders) - interval 720 hour)""")
def recent_json_predicate(spark, sf_dir):
    """Customers whom no log row of the last 720 hours with status 200 names."""
    o = _t(spark, sf_dir, "orders")
    log = o.select(F.when(F.col("o_orderstatus") == "O", 200).otherwise(500).alias("response_status"), F.col("o_orderdate").alias("created_at"), F.to_json(F.struct(F.concat(F.lit("customer_"), F.col("o_custkey").cast("string")).alias("k"))).alias("response_body"))
    newest = o.agg(F.max("o_orderdate").alias("_now"))
    log = log.crossJoin(F.broadcast(newest))
    requests = _t(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("customer_"), F.col("c_custkey").cast("string")).alias("k"))
    return checks.unanswered(requests, log, "k", F.col("_now"), 720)


@query("""select o_orderkey, json_object('side', o_orderstatus, 'mw', o_custkey) payload, case when o_orderstatus <> 'P' then json_object('position_id', o_orderkey) end response_body, o_orderdate created_at from orders""")
def audit_log(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("side"), F.col("o_custkey").alias("mw"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("position_id"), F.col("o_orderdate").alias("_at"))
    return upsert.audit_rows(o, ["side", "mw"], ["position_id"], F.col("_at")).drop("_at")


@query("""with t as (select event_id, ts, value from events where ts < timestamp '2024-01-15' and event_id % 3 <> 0) select * from t union all select event_id, ts, value from events where ts >= (select max(ts) - interval 5 day from t) and event_id not in (select event_id from t)""")
def lookback_sync(spark, sf_dir):
    """A copy that lacks rows is filled from five days before its newest row on."""
    e = _t(spark, sf_dir, "events").select("event_id", "ts", "value")
    behind = e.where("ts < timestamp_ntz '2024-01-15 00:00:00' and event_id % 3 <> 0")
    return upsert.sync({"events": ("ts", ["event_id"])}, {"events": behind}, {"events": e}, 5)["events"]


@query("""select s_suppkey id, s_acctbal balance, cast(null as varchar) name, 'supplier' party from supplier union all select c_custkey, c_acctbal, c_name, 'customer' from customer""")
def consolidated(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"))
    return reshape.consolidate({"supplier": s, "customer": c}, "party").select("id", "balance", "name", "party")


@query("""select l_orderkey, l_linenumber, cast(round_even(cast(l_tax * 100 as int) * 10 + 25, -1) / 10 as double) tens, cast(round_even(cast(l_extendedprice as decimal(20, 2)), 1) as double) price from lineitem""")
def half_even_decimals(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    tens = stats.half_even(F.round(F.col("l_tax") * 100).cast("int") + F.lit(2.5).cast("decimal(5,1)"), 0)
    return li.select("l_orderkey", "l_linenumber", tens.cast("double").alias("tens"), stats.half_even("l_extendedprice", 1).cast("double").alias("price"))


@query("select event_id, value afrr_plus_eur, value afrr_minus_eur from events")
def one_value_two_names(spark, sf_dir):
    return reshape.duplicated(_t(spark, sf_dir, "events").select("event_id", "value"), "value", ["afrr_plus_eur", "afrr_minus_eur"])


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders)")
def areas_without_data(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return checks.without_data(_t(spark, sf_dir, "customer").select("c_custkey"), o, ["c_custkey"])


@query("""with t as (select c_custkey id, nullif(c_nationkey, 3) k from customer), s as (select s_suppkey id, nullif(s_nationkey, 3) k from supplier) select id, k from t union all select id, k from s where not exists (select 1 from t where t.k = s.k)""")
def null_keys_repeat(spark, sf_dir):
    """Suppliers whose nation no stored row has; nation 3 is unknown, and an unknown key never matches."""
    key = lambda c: F.nullif(F.col(c), F.lit(3)).alias("k")
    t = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), key("c_nationkey"))
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), key("s_nationkey"))
    return upsert.insert_absent(t, s, ["k"])


@query("""with a as (select o_custkey k, count(*) orders_n from orders where o_orderstatus = 'F' group by 1), b as (select o_custkey k, max(o_totalprice) most from orders where o_orderstatus = 'O' group by 1) select coalesce(a.k, b.k) k, coalesce(orders_n, 0) orders_n, coalesce(most, -1) most from a full join b on b.k = a.k""")
def combined_defaults(spark, sf_dir):
    """The union of two series' keys, with defaults for what one side lacks."""
    o = _t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    a = o.where("o_orderstatus = 'F'").groupBy("k").agg(F.count("*").alias("orders_n"))
    b = o.where("o_orderstatus = 'O'").groupBy("k").agg(F.max("o_totalprice").alias("most"))
    return reshape.combine(a, b, ["k"], {"orders_n": 0, "most": -1.0})


@query("select event_type, value, case event_type when 'click' then 'B16' when 'view' then 'B18' when 'purchase' then 'B19' when 'signup' then 'B02' when 'error' then 'B05' end psr_type, event_id from events")
def mapped_codes(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_type", "value", reshape.mapped(F.col("event_type"), _PSR).alias("psr_type"), "event_id")


# Streams: the tables' rows as files in any order, through keyed state and timers.


@query(SQL["latest_version"])
def stream_latest_version(spark, sf_dir):
    """Orders as versions of their customers' outages, in any order; the last that comes out of each is the latest."""
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = scratch(spark, "versions")
    stream = live.replayed(o, f"{path}/in", 4, F.col("o_orderkey"), 2, spark.sparkContext.defaultParallelism)
    order = [("o_orderdate", True), ("o_totalprice", True), ("o_orderkey", True)]
    out = live.emptied(live.superseding(stream, ["o_custkey"], order, "o_orderdate", "o_orderdate", "20000 days"), f"{path}/out", f"{path}/state")
    last = out.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderstatus", "o_orderdate"), "batch").alias("r"))
    return last.select("o_custkey", "r.*")


@query(SQL["resample60_gated"])
def stream_hours_gated(spark, sf_dir):
    """Quarters in any order; hours come out when their fourth quarter has come."""
    e = _t(spark, sf_dir, "events")
    start = T.floor_to(F.col("ts"), 15)
    q = e.groupBy("event_type", start.alias("start")).agg(F.avg("value").alias("value_mean"), stats.median("value").alias("value_median"), stats.last_by("value", "ts", "event_id").alias("value_last"))
    q = q.withColumn("time_interval", T.label(F.col("start"))).withColumn("start", F.col("start").cast("timestamp"))
    path = scratch(spark, "hours")
    values = ["value_mean", "value_median", "value_last"]
    stream = live.replayed(q, f"{path}/in", 4, F.concat("event_type", F.col("start").cast("string")), 2)
    out = live.emptied(live.gated_hours(stream, ["event_type"], "start", values, "20000 days"), f"{path}/out", f"{path}/state")
    rules = {"value_mean": ("mean", "value_mean"), "value_median": ("mean", "value_median"), "value_last": ("last", "value_last")}
    whole = out.withColumn("trade_date", F.to_date("hour_start"))
    return resample.roll_up(whole, rules, ["event_type"]).withColumns({c: F.round(c, 8) for c in ("value_mean", "value_median")})


# Late data: only what is stale is computed again.


@query("""with q as (select time_bucket(interval 15 minute, ts) b, avg(value) / 3 v from events group by 1), h as (select date_trunc('hour', b) hour_start, avg(v) v from q group by 1)
 select hour_start, round(v, 8) v, round(avg(v) over (order by hour_start rows 15 preceding), 8) roll_16, round(sum(v) over (order by hour_start rows 15 preceding), 8) integral_16 from h""")
def dirty_recompute(spark, sf_dir):
    """Each ninth day's events come late: quarters, hours and rolling frames that they make stale are
    computed again, and equal a run over everything."""
    e = _t(spark, sf_dir, "events").select("event_id", "ts", "value")
    late = F.dayofmonth("ts") % 9 == 0
    path = scratch(spark, "layers")

    def stored(df, name):
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    def quarters(rows):
        return rows.groupBy(T.floor_to(F.col("ts"), 15).alias("b")).agg((F.avg("value") / 3).alias("v"))  # thirds, which no rounding meets halfway

    def hours(rows):
        return rows.groupBy(F.date_trunc("hour", "b").alias("hour_start")).agg(F.avg("v").alias("v"))

    frames = {"roll_16": ("mean", 15), "integral_16": ("sum", 15)}

    def rolled(rows):
        return resample.rolling_blocks(rows.withColumn("day", F.to_date("hour_start")), "v", "day", ["hour_start"], frames).drop("day")

    early = e.where(~late)
    q0 = stored(quarters(early), "q0")
    h0 = stored(hours(q0), "h0")
    r0 = stored(rolled(h0), "r0")
    # The late rows arrive.
    stale_q = stored(ledger.touched(e.where(late), "ts", []), "stale_q")
    q1 = stored(ledger.recomputed(q0, stale_q, [], "b", lambda stale: quarters(ledger.only(e, stale.withColumnRenamed("b", "start"), [], T.floor_to(F.col("ts"), 15)))), "q1")
    stale_h = stored(ledger.coarser(stale_q, []), "stale_h")
    h1 = stored(ledger.recomputed(h0, stale_h, [], "hour_start", lambda stale: hours(ledger.only(q1, stale.withColumnRenamed("hour_start", "start"), [], F.date_trunc("hour", "b")))), "h1")
    stale_r = stored(ledger.reached(h1, stale_h, [], "hour_start", 15), "stale_r")
    return ledger.recomputed(r0, stale_r, [], "hour_start", lambda stale: _framed(h1, stale, frames)).select("hour_start", *[F.round(c, 8).alias(c) for c in ("v", *frames)])


def _framed(hours: DataFrame, stale: DataFrame, frames: dict) -> DataFrame:
    """Frames of stale rows, from them and the rows that their frames reach back to."""
    most = max(n for _, n in frames.values())
    needed = ledger.reached(hours, stale.withColumnRenamed("hour_start", "start"), [], "hour_start", most, backward=True)
    rows = hours.join(needed.withColumnRenamed("start", "hour_start"), "hour_start", "left_semi")
    out = resample.rolling_blocks(rows.withColumn("day", F.to_date("hour_start")), "v", "day", ["hour_start"], frames).drop("day")
    return out.join(stale, "hour_start", "left_semi")


@query("""with s as (select event_type, date_trunc('hour', ts) "start", count(*) n from events group by 1, 2) select event_type, "start", n from s""")
def gaps_refilled(spark, sf_dir):
    """A table of hours that lacks some whole days is searched for gaps, and refilled from its source."""
    e = _t(spark, sf_dir, "events")
    source = e.groupBy("event_type", F.date_trunc("hour", "ts").alias("start")).agg(F.count("*").alias("n"))
    edge = Window.partitionBy("event_type")
    ends = source.withColumns({"_a": F.min("start").over(edge), "_b": F.max("start").over(edge)})
    table = ends.where((F.dayofmonth("start") % 5 != 0) | (F.col("start") == F.col("_a")) | (F.col("start") == F.col("_b"))).drop("_a", "_b")
    missing = ledger.gaps(table, "start", ["event_type"], F.min("start"), F.max("start"), "1 hour")
    return ledger.refilled(table, source, missing, ["event_type"], "start")


@query("""select event_id, cast(ts as date) as day, case when day(ts) in (5, 6) then value * 2 else value end "value" from events union all select event_id + 10000000, cast(ts as date) + 60, value from events where day(ts) = 5""")
def upsert_partitions(spark, sf_dir):
    """Events by day, of which two days are corrected and one is copied 60 days on; only those partitions are written."""
    e = _t(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"), "value")
    path = scratch(spark, "events")
    upsert.merge_partitions(path, e, ["day", "event_id"], ["day"])
    fifth = e.where(F.dayofmonth("day") == 5)
    changed = e.where(F.dayofmonth("day").isin(5, 6)).withColumn("value", F.col("value") * 2)
    added = fifth.select((F.col("event_id") + 10000000).alias("event_id"), F.date_add("day", 60).alias("day"), "value")
    upsert.merge_partitions(path, changed.unionByName(added), ["day", "event_id"], ["day"])
    return spark.read.schema(e.schema).parquet(path).select("event_id", "day", "value")


# Archives, spreadsheets, arrivals; decisions and quantiles.


def _boxed_lines(spark, sf_dir) -> DataFrame:
    """Lines with box, the archive or workbook of their order, by which they are dealt out. So many parts as the session says:
    fewer, which would do for the lines, are too few for the files that are made of them."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _t(spark, sf_dir, "lineitem").withColumn("box", F.floor(F.col("l_orderkey") / 50)).repartition(parts, "box")


def _files(rows: DataFrame, made: Callable[[dict[str, str]], bytes]) -> DataFrame:
    """content, a file for each box, made of its orders' texts by key; of a box's rows, which are in one part, those of an
    order are joined by n. Rows come one by one, so that a task holds a file and a batch of rows."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda out: pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["content"])
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        box_of, key_of, n_of = (operator.itemgetter(i) for i in range(3))
        out: list[bytes] = []
        for _, box in itertools.groupby(rows, box_of):
            out.append(made({str(k): "".join([r[3] for r in sorted(own, key=n_of)]) for k, own in itertools.groupby(box, key_of)}))
            if sum(map(len, out)) >= FILES:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return rows.select("box", "l_orderkey", "n", "text").sortWithinPartitions("box", "l_orderkey").mapInArrow(files, "content binary")


@query(SQL["xml_outages"])
def archived_outages(spark, sf_dir):
    """The documents of outages in archives of some, of which each third is in an archive of its own within."""

    def archive(entries) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, content in entries:
                z.writestr(name, content)
        return out.getvalue()

    def packed(texts: dict[str, str]) -> bytes:
        entries = [(f"{k}.xml", t) for k, t in texts.items()]
        return archive([(f"{n}.zip", archive([(n, t)])) if i % 3 == 0 else (n, t) for i, (n, t) in enumerate(entries)] + [("notes.txt", "no document")])

    boxes = _files(_outage_docs(_boxed_lines(spark, sf_dir), "box").withColumn("n", F.lit(1)), packed)
    texts = archives.documents(boxes).select(F.regexp_extract("member", r"(\d+)\.xml$", 1).cast("long").alias("l_orderkey"), "text")
    return _outages(texts)


def _books_of_orders(spark, sf_dir, head: Column, row: Column) -> DataFrame:
    """content, workbooks: each order is a sheet of its box's workbook, its head and then its lines, whose number is n."""
    order = Window.partitionBy("box", "l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = _boxed_lines(spark, sf_dir).withColumn("n", F.row_number().over(order))
    return _files(lines.withColumn("text", F.when(F.col("n") == 1, F.concat(head, row)).otherwise(row)), archives.workbook)


def _of_orders(rows: DataFrame) -> DataFrame:
    return rows.withColumn("l_orderkey", F.col("sheet").cast("long"))


@query("""with k as (select l_orderkey, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as int) n, l_extendedprice p, l_quantity v, l_tax x from lineitem)
 select l_orderkey, n as "period", p price, v volume, cast(null as double) purchase_60, x exported, true is_15min from k where l_orderkey % 2 = 0
 union all select l_orderkey, cast((n - 1) * 4 + q.range as int), p, v / 4, v / 4, x / 4, false from k cross join range(1, 5) q where l_orderkey % 2 = 1""")
def sheet_prices(spark, sf_dir):
    """Orders as day-ahead sheets of workbooks, of quarters or, each second one, in the hourly layout, told apart by their cells."""
    title = [["Day-Ahead Market"], []]
    quarters = title + [["Period", "Time interval", "15 min price\n(EUR/MWh)", "Volume\n(MWh)", "Export\n(MWh)"]]
    hours = title + [["Hour", "Price (EUR/MWh)", "Volume\n(MWh)", "Export"], [None, None, "Sale"]]
    new, values = F.col("l_orderkey") % 2 == 0, [F.col(c) for c in ("l_extendedprice", "l_quantity", "l_tax")]
    head = F.when(new, archives.rows_xml(quarters)).otherwise(archives.rows_xml(hours))
    row = F.when(new, archives.row_xml(F.col("n"), T.period_label(F.col("n")), *values)).otherwise(archives.row_xml(F.col("n"), *values))
    out = sheets.day_ahead(_of_orders(archives.workbook_tables(_books_of_orders(spark, sf_dir, head, row), sheets.DAY_AHEAD)), ["l_orderkey"])
    return out.select("l_orderkey", "period", F.col("price_15min_eur_mwh").alias("price"), F.col("volume_mwh").alias("volume"), F.col("purchase_60min_products_mwh").alias("purchase_60"), F.col("export_mwh").alias("exported"), "is_15min")


@query("""with k as (select l_orderkey, l_shipdate, l_quantity, l_extendedprice, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 i from lineitem where l_linenumber <> 4)
 select l_orderkey, 2024010500000 + i trade_id, l_quantity qty_mw, l_extendedprice price_eur_mwh, l_shipdate exec_time from k""")
def sheet_ticks(spark, sf_dir):
    """Orders as sheets of trades in workbooks; each fourth line is cancelled."""
    none, price = F.lit(None).cast("string"), F.col("l_extendedprice")
    amount = F.when(F.col("l_linenumber") == 4, "SN").otherwise(F.col("l_quantity").cast("string"))
    row = archives.row_xml(F.lit("20240105 10:00-20240105 10:15"), none, none, F.lit("N"), amount, F.lit(1.5), price, F.lit(2), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    head = F.lit(archives.rows_xml([["Trades"], [], ["of the day"], ["Kontrakt"], ["Kontrakt", None, None, None, "MW"]]))
    rows = archives.workbook_rows(_books_of_orders(spark, sf_dir, head, row))
    return sheets.ticks(_of_orders(rows), ["l_orderkey"], F.lit("2024-01-05").cast("date")).select("l_orderkey", "trade_id", "qty_mw", "price_eur_mwh", "exec_time")


@query("""select event_id, event_type, case when event_type = 'view' then value + 1 else value end "value" from events""")
def arrivals_read_once(spark, sf_dir):
    """Events as files by type, read in three runs: all but one type, a new and a changed one, and nothing new."""
    e = _t(spark, sf_dir, "events")
    path = scratch(spark, "arrivals")

    def deliver(rows: DataFrame) -> None:
        line = F.to_json(F.struct("event_id", "event_type", "value")).alias("value")
        rows.select(line, F.col("event_type").alias("kind")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind").text(f"{path}/in")

    def read(found: DataFrame) -> DataFrame:
        lines = found.select("path", F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("_l")).where("_l <> ''")
        return lines.select("path", F.from_json("_l", "event_id LONG, event_type STRING, value DOUBLE").alias("_r")).select("path", "_r.*")

    def run(n: int) -> DataFrame:
        arrivals.take_in(spark, f"{path}/in", f"{path}/table", f"{path}/ledger", read, n, "part-*")
        return spark.read.parquet(f"{path}/table")

    deliver(e.where("event_type not in ('purchase', 'view')"))
    run(1)
    deliver(e.where("event_type = 'purchase'").unionByName(e.where("event_type = 'view'").withColumn("value", F.col("value") + 1)))
    run(2)
    return run(3).select("event_id", "event_type", "value")


@query("""with v as (select *, o_orderdate a, o_orderdate + to_days(cast(o_orderkey % 5 + 1 as int)) b, o_orderdate - to_days(cast(o_custkey % 30 as int)) created from orders),
 q as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, o_custkey, cast(o_orderdate as date) + l_linenumber - 1 slot, o_orderdate - to_days(cast(l_linenumber * 4 as int)) decided from lineitem join orders on o_orderkey = l_orderkey)
 select q.l_orderkey, q.l_linenumber, q.l_partkey, q.l_suppkey, q.l_quantity, q.l_extendedprice, arg_max(v.o_orderkey, row(v.created, v.o_orderkey)) known, arg_max(v.o_totalprice, row(v.created, v.o_orderkey)) known_mw
 from q left join v on v.o_custkey = q.o_custkey and v.a < q.slot + interval 1 day and v.b > q.slot and v.created <= q.decided group by q.l_orderkey, q.l_linenumber, q.l_partkey, q.l_suppkey, q.l_quantity, q.l_extendedprice, q.o_custkey, q.slot, q.decided""")
def known_at_each_decision(spark, sf_dir):
    """Orders as outages that are published some days ahead; each line asks, some days before its own, what was known then of its day."""
    o = _t(spark, sf_dir, "orders")
    back = lambda days: F.col("o_orderdate") - F.make_dt_interval(days.cast("int"))
    versions = o.select("o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").alias("a"), (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 5 + 1).cast("int"))).alias("b"), back(F.col("o_custkey") % 30).alias("created"))
    li = _t(spark, sf_dir, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"), "l_orderkey")
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    asked = li.select(*names, "o_custkey", F.date_add(F.to_date("o_orderdate"), F.col("l_linenumber") - 1).alias("slot"), back(F.col("l_linenumber") * 4).alias("decided"))
    asked = asked.groupBy(*asked.columns).count().drop("count")
    out = intervals.known_at(asked, versions, ["o_custkey"], "slot", "decided", "a", "b", "created", ["o_orderkey"], ["o_orderkey", "o_totalprice"], "1 day")
    return out.select(*names, F.col("o_orderkey").alias("known"), F.col("o_totalprice").alias("known_mw"))


@query("""select l_returnflag flag, quantile_cont(l_extendedprice, 0.5) price_median, quantile_cont(l_extendedprice, 0.95) price_p95 from lineitem group by 1 union all select 'all', quantile_cont(l_extendedprice, 0.5), quantile_cont(l_extendedprice, 0.95) from lineitem""")
def quantiles_of_large_groups(spark, sf_dir):
    """Medians and 95 % quantiles of three groups and of all rows, without a task that holds a group."""
    li = _t(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_returnflag").alias("flag"), "l_extendedprice").unionByName(li.select(F.lit("all").alias("flag"), "l_extendedprice"))
    return quantiles.quantiles(rows, ["flag"], "l_extendedprice", {"price_median": 0.5, "price_p95": 0.95})
