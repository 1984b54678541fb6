"""The market tables' own pipelines: which rule each column has on its way from minutes and
documents to quarters and hours. The operators do the work; this is the wiring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.functions import stats
from tidewatt.functions import timegrid as T
from tidewatt.operators import intervals, resample, reshape
from tidewatt.operators.resample import Rule
from tidewatt.sources.documents import GENERATION, PRICE_PARTS

#: Fixed limits of the features: minutes a quarter must have, and the prices that count as floor and peak.
LEAST_MINUTES, FLOOR_EUR, PEAK_EUR = 12, -500, 500


def stat_name(column: str, stat: str) -> str:
    """system_imbalance_mw -> system_imbalance_mean_mw; the unit stays last."""
    for unit in ("_eur_mwh", "_mw"):
        if column.endswith(unit):
            return f"{column.removesuffix(unit)}_{stat}{unit}"
    return f"{column}_{stat}"


def minute_statistics(minutes: DataFrame, values: list[str], ts: str = "delivery_timestamp", only: DataFrame | None = None) -> DataFrame:
    """Mean, median and last of each value by quarter. only: trade_date and time_interval of the
    quarters to compute, as :func:`resample.touched_intervals` gives them; they are few."""
    if only is not None:
        start = T.floor_to(F.col(ts), 15)
        here = minutes.withColumn("trade_date", F.to_date(start)).withColumn("time_interval", T.label(start))
        minutes = here.join(only, ["trade_date", "time_interval"], "left_semi").select(*minutes.columns)
    rules: dict[str, Rule] = {stat_name(v, s): (s, v) for v in values for s in ("mean", "median", "last")}
    return resample.downsample(minutes, ts, rules)


def minute_features(prices: DataFrame, imbalance: DataFrame, exchange: DataFrame, activation: DataFrame, minutes: int = 15) -> DataFrame:
    """trade_date, time_interval, minute_count and 29 features. Quarters are null below
    LEAST_MINUTES; hours (minutes=60) are there only with all 60 minutes."""
    ts = "delivery_timestamp"
    j = prices
    for part in (imbalance, exchange, activation):
        j = j.join(part, ts, "left")
    j = j.withColumn("_day", F.to_date(ts)).withColumn("_start", T.floor_to(F.col(ts), minutes) if minutes < 60 else F.date_trunc("hour", ts))
    # The day's limit is of all minutes of the exchange table, with or without a price.
    limits = exchange.groupBy(F.to_date(ts).alias("_day")).agg(stats.quantile(F.abs("picasso_afrr_mw"), 0.95).alias("_limit"))
    j = j.join(limits, "_day", "left")
    full = F.coalesce(F.abs("picasso_afrr_mw") >= F.coalesce("_limit", F.lit(999999)) * 0.95, F.lit(False))
    minute = F.minute(ts) - F.minute("_start")
    up = F.col("afrr_plus_mw") + F.col("mfrr_plus_mw")
    x = "system_imbalance_mw"
    features: dict[str, Column] = {}
    for side in ("afrr_plus", "afrr_minus", "mfrr_plus", "mfrr_minus"):
        p = f"price_{side}_eur_mwh"
        features |= {f"{side}_min_eur": F.min(p), f"{side}_max_eur": F.max(p), f"{side}_std_eur": F.stddev_samp(p), f"{side}_skew": stats.skew(p)}
    features |= {
        "imbalance_range_mw": F.max(x) - F.min(x), "imbalance_std_mw": F.stddev_samp(x), "imbalance_slope": stats.slope(F.col(x).cast("double"), minute.cast("double")),
        "minutes_at_floor": F.count_if(F.col("price_afrr_minus_eur_mwh") <= FLOOR_EUR), "minutes_near_peak": F.count_if(F.col("price_afrr_plus_eur_mwh") >= PEAK_EUR), "saturation_count": F.count_if(full),
        "total_active_mean_mw": F.avg(up), "total_active_std_mw": F.stddev_samp(up), "platform_active_count": F.count_if((F.col("picasso_afrr_mw") != 0) | (F.col("mari_mfrr_mw") != 0)),
    }
    for side in ("plus", "minus"):
        spread = F.col(f"price_afrr_{side}_eur_mwh") - F.col(f"price_mfrr_{side}_eur_mwh")
        features |= {f"afrr_mfrr_{side}_spread_mean_eur": F.avg(spread), f"afrr_mfrr_{side}_spread_std_eur": F.stddev_samp(spread)}
    names = list(features)
    out = j.groupBy("_start").agg(F.count("*").alias("minute_count"), *[c.alias(n) for n, c in features.items()])
    out = resample.gated(out, "minute_count", LEAST_MINUTES, names) if minutes < 60 else out.where(F.col("minute_count") == 60)
    return out.select(F.to_date("_start").alias("trade_date"), T.label(F.col("_start"), minutes).alias("time_interval"), "minute_count", *names)


SOURCES = ("tpp_mw", "ccgt_mw", "npp_mw", "hpp_mw", "pspp_mw", "altpp_mw", "appp_mw", "wpp_mw", "pvpp_mw")


def derived_features(imbalance: DataFrame, generation: DataFrame, plan: DataFrame, forecast: DataFrame, country: str = "CZ") -> DataFrame:
    """Rolling imbalance over 8 and 16 quarters, and generation against plan and forecast. The wind
    error has no source and stays null."""
    key = ["trade_date", "time_interval"]
    x = "system_imbalance_mean_mw"
    rolled = resample.rolling_blocks(imbalance.select(*key, x), x, "trade_date", key, {"imb_roll_2h": ("mean", 7), "imb_roll_4h": ("mean", 15), "imb_integral_4h": ("sum", 15)})
    ahead = forecast.where(F.col("country_code") == country).select(*key, "forecast_solar_mw")
    g = generation.join(ahead, key, "left").join(plan.select(*key, "total_mw"), key, "left")
    errors = g.select(*key, (F.col("pvpp_mw") - F.col("forecast_solar_mw")).alias("solar_error_mw"), F.lit(None).cast("double").alias("wind_error_mw"), (stats.none_as_zero(*SOURCES) - F.col("total_mw")).alias("gen_total_error_mw"))
    return rolled.join(errors, key, "left").drop(x)


def _all(rule: str, names: str) -> dict[str, Rule]:
    return {n: (rule, n) for n in names.split()}


def _statistics(names: str, unit: str) -> dict[str, Rule]:
    """Means of the quarters' means and medians, and the last of their last values."""
    return {f"{n}_{s}_{unit}": ("last" if s == "last_at_interval" else "mean", f"{n}_{s}_{unit}") for n in names.split() for s in ("mean", "median", "last_at_interval")}


#: Hours from quarters: table -> (keys beside the day, rules). All have the gate of four quarters.
ROLL_UPS: dict[str, tuple[list[str], dict[str, Rule]]] = {
    "imbalance": ([], _all("mean", "system_imbalance_mean_mw system_imbalance_median_mw")),
    "estimated_price": ([], _all("mean", "estimated_price_czk_mwh")),
    "re_price": ([], _statistics("price_afrr_plus price_afrr_minus price_mfrr_plus price_mfrr_minus price_mfrr_5", "eur_mwh")),
    "svr_activation": ([], _statistics("afrr_plus afrr_minus mfrr_plus mfrr_minus", "mw")),
    "export_import_svr": ([], _statistics("imbalance_netting mari_mfrr picasso_afrr sum_exchange", "mw")),
    "minute_generation": ([], _all("mean", "tpp_mw ccgt_mw npp_mw hpp_mw pspp_mw altpp_mw appp_mw wpp_mw pvpp_mw")),
    "generation_plan": ([], _all("mean", "total_mw")),
    "generation_res": ([], _statistics("wind solar", "mw")),
    "derived": ([], _all("last", "imb_roll_2h imb_roll_4h imb_integral_4h solar_error_mw wind_error_mw gen_total_error_mw")),
    "da_period_summary": ([], _all("mean", "clearing_price supply_next_price supply_price_gap demand_next_price demand_price_gap") | _all("sum", "clearing_volume supply_next_volume supply_volume_gap demand_next_volume demand_volume_gap")),
    "da_curve_depth": ([], _all("mean", "clearing_price " + " ".join(f"{d}_{w}" for d in ("supply", "supply_matched", "demand", "demand_matched") for w in ("mw", "price", "slope")))),
    "ida": (["ida_idx"], {"price_eur_mwh": ("vwap", "price_eur_mwh", "volume_mwh")} | _all("sum", "volume_mwh saldo_mwh export_mwh import_mwh")),
    "settlement": ([], _all("sum", "system_imbalance_mwh absolute_imbalance_sum_mwh positive_imbalance_mwh negative_imbalance_mwh rounded_imbalance_mwh cost_of_be_czk cost_of_imbalance_czk") | _all("mean", "settlement_price_imbalance_czk_mwh settlement_price_counter_imbalance_czk_mwh")),
    "weather_forecast": (["forecast_made_at"], _all("mean", "temperature radiation direct_radiation cloud wind")),
    "weather_current": ([], _all("mean", "temperature radiation direct_radiation cloud wind")),
    "load": (["area_id", "country_code"], _all("mean", "actual_load_mw forecast_load_mw")),
    "generation": (["area_id", "country_code"], _all("mean", "gen_biomass_mw gen_coal_mw gen_gas_mw gen_hydro_other_mw gen_hydro_pumped_mw gen_nuclear_mw gen_solar_mw gen_wind_mw gen_wind_offshore_mw")),
    "generation_forecast": (["area_id", "country_code"], _all("mean", "forecast_solar_mw forecast_wind_mw forecast_wind_offshore_mw")),
    "scheduled_flows": ([], _all("mean", "scheduled_de_mw scheduled_at_mw scheduled_pl_mw scheduled_sk_mw scheduled_total_net_mw")),
    "day_ahead_prices": (["area_id", "country_code"], _all("mean", "price_eur_mwh")),
    "flows": (["area_id"], _all("mean", "flow_de_mw flow_at_mw flow_pl_mw flow_sk_mw flow_total_net_mw")),
    "imbalance_prices": (["area_id", "country_code"], _all("mean", " ".join(f"{side}_imb_{v}_mwh" for side in ("pos", "neg") for v in ("price", *PRICE_PARTS.values()))) | _all("sum", "imbalance_mwh difference_mwh") | _all("last", "situation status") | _all("any", "currency")),
    "outages": (["area_id", "country_code"], {"total_out_mw": ("mean", "total_out_mw"), "peak_out_mw": ("max", "total_out_mw"), "n_units": ("max", "n_units")}),
}


def hourly(table: str, quarters: DataFrame) -> DataFrame:
    """The hours of a table; where quarters have their delivery_datetime, the start of the first one's hour, too."""
    keys, rules = ROLL_UPS[table]
    if "delivery_datetime" in quarters.columns:
        rules = rules | {"delivery_datetime": ("hour", "delivery_datetime")}
    return resample.roll_up(quarters, rules, keys)


# Documents' points (sources.curve_points) to the grid. sequence numbers the order in which documents and series came.


def on_grid(points: DataFrame) -> DataFrame:
    """Adds trade_date, period and fold in local time; at is the UTC instant."""
    local = T.to_local(F.col("at"))
    return points.withColumn("trade_date", F.to_date(local)).withColumn("period", T.period(local)).withColumn("fold", T.fold(F.col("at")))


#: A period of local time, and the same with fold, which tells an autumn's repeated hour apart.
LOCAL_KEY = ["trade_date", "period"]
_KEY = [*LOCAL_KEY, "fold"]
_AREA = ["area_id", "country_code"]
_SERIES = ["doc", "series", "part", "period_start", "resolution"]


def _key(points: DataFrame, fold: bool = True) -> list[str]:
    """The period, within the areas where points name them, so that several areas can be in one frame."""
    return [*[c for c in _AREA if c in points.columns], *(_KEY if fold else LOCAL_KEY)]


def _filled(points: DataFrame, values: list[str], extra: list[str]) -> DataFrame:
    """All positions of each period, forward-filled from 0, on the grid."""
    series = [*[c for c in _AREA if c in points.columns], *_SERIES]
    per = points.groupBy(*series).agg(*[F.first(c, ignorenulls=True).alias(c) for c in extra])
    full = reshape.fill_forward(points, series, "position", "length", values).join(per, series)
    return on_grid(full.withColumn("at", reshape.point_time(F.col("period_start"), F.col("position"), F.col("resolution"))))


def _sequence() -> Column:
    return F.struct("doc", "series", "part", "position")


def imbalance_prices(prices: DataFrame, volumes: DataFrame) -> DataFrame:
    """Prices of positive (A04) and negative (A05) imbalance with the volumes and situation of the
    system; prices without volumes have 0.0 and surplus. Documents have doc, series, part. A point
    without one of the parts of a price has 0.0 for it. Where prices have doc_status and currency, status
    is that of the last price's document, A01 without prices, and currency that of the area's last
    document, EUR without one."""
    key = _key(prices)
    parts = [*PRICE_PARTS.values()]
    none = F.lit(None).cast("double")
    p = _filled(prices.withColumns({c: F.coalesce(c if c in prices.columns else none, F.lit(0.0)) for c in parts}), ["price", *parts], ["category", *(["doc_status"] if "doc_status" in prices.columns else [])])
    of = lambda c, value: F.coalesce(F.max_by(F.when(F.col("category") == c, F.col(value)), F.when(F.col("category") == c, _sequence())), F.lit(0.0))
    columns = {f"{side}_imb_{v}_mwh": of(c, v) for c, side in (("A04", "pos"), ("A05", "neg")) for v in ["price", *parts]}
    told = "doc_status" in prices.columns
    status = [F.max_by("doc_status", _sequence()).alias("status")] if told else []
    p = p.groupBy(*key).agg(*[c.alias(n) for n, c in columns.items()], *status)
    v = _filled(volumes, ["quantity", "difference"], ["direction"])
    situation = reshape.mapped(F.col("direction"), {"A01": "surplus", "A02": "deficit", "A03": "balanced"})
    v = v.groupBy(*key).agg(F.max_by("quantity", _sequence()).alias("imbalance_mwh"), F.max_by("difference", _sequence()).alias("difference_mwh"), F.max_by(situation, _sequence()).alias("situation"))
    out = reshape.combine(p, v, key, {**dict.fromkeys(columns, 0.0), **({"status": "A01"} if told else {}), "imbalance_mwh": 0.0, "situation": "surplus"})
    if "currency" not in prices.columns:
        return out
    areas = [c for c in _AREA if c in prices.columns]
    last = prices.groupBy(*areas).agg(F.max_by("currency", F.when(F.col("currency").isNotNull(), F.col("doc"))).alias("currency"))
    joined = out.join(last, areas, "left") if areas else out.crossJoin(F.broadcast(last))
    return joined.withColumn("currency", F.coalesce("currency", F.lit("EUR")))


def load(actual: DataFrame, forecast: DataFrame, fold: bool = False) -> DataFrame:
    """Last value wins; a null quantity counts as a value. fold: key rows by fold as well; without,
    the later of an autumn's repeated hours overwrites the earlier, as in the table's key."""
    key = _key(actual, fold)
    last = lambda df, name: on_grid(df).groupBy(*key).agg(F.max_by("quantity", _sequence()).alias(name))
    return last(actual, "actual_load_mw").join(last(forecast, "forecast_load_mw"), key, "full_outer")


def generation(points: DataFrame, kinds: dict[str, str], how: str = "sum", fold: bool = False) -> DataFrame:
    """A column for each kind of plant; points have psr_type. The finest resolution of a period and
    column counts; there, series are summed, or the first (for forecasts) or last counts.
    fold: key rows by fold as well; without, an autumn's repeated hours fall together."""
    key = _key(points, fold)
    rows = on_grid(points).withColumn("_column", reshape.mapped(F.col("psr_type"), kinds)).where("_column is not null").withColumn("_seq", _sequence())
    fine = reshape.finest(rows, [*key, "_column"], "resolution")
    names = sorted(set(kinds.values()))
    out = reshape.widen(fine, key, "_column", "quantity", names, how, "_seq")
    return out.select(*key, *[F.col(n).alias(f"gen_{n}_mw") for n in names])


def wind(points: DataFrame, fold: bool = False) -> DataFrame:
    """Onshore, offshore and total wind of an area; the last of the finest resolution counts. The
    total is null where both are."""
    kinds = {k: c for k, c in GENERATION.items() if c.startswith("wind")}
    out = generation(points.withColumn("quantity", F.coalesce("quantity", F.lit(0.0))), kinds, "last", fold)
    on, off = F.col("gen_wind_mw"), F.col("gen_wind_offshore_mw")
    total = F.when(on.isNotNull() | off.isNotNull(), stats.none_as_zero(on, off))
    return out.select(*_key(points, fold), on.alias("wind_onshore_mw"), off.alias("wind_offshore_mw"), total.alias("wind_total_mw"))


def flows(points: DataFrame, home: str, borders: dict[str, str]) -> DataFrame:
    """Signed flows by border, positive into home; of the finest resolution the last value wins and
    is not netted."""
    key = _key(points)
    rows = on_grid(points).withColumn("_in", F.col("in_domain") == home)
    border = reshape.mapped(F.when(F.col("_in"), F.col("out_domain")).otherwise(F.col("in_domain")), borders)
    rows = rows.withColumn("_border", border).where("_border is not null").withColumn("_v", F.when(F.col("_in"), F.col("quantity")).otherwise(-F.col("quantity"))).withColumn("_seq", _sequence())
    names = sorted(set(borders.values()))
    out = reshape.widen(reshape.finest(rows, [*key, "_border"], "resolution"), key, "_border", "_v", names, "last", "_seq")
    return out.select(*key, *[F.col(n).alias(f"flow_{n}_mw") for n in names], stats.none_as_zero(*names).alias("flow_total_net_mw"))


def scheduled_exchanges(points: DataFrame, home: str, borders: dict[str, str]) -> DataFrame:
    """Signed sums by border, positive into home; a total of 0 is null."""
    key = _key(points)
    rows = on_grid(points).withColumn("_in", F.col("in_domain") == home)
    rows = rows.withColumn("_border", reshape.mapped(F.when(F.col("_in"), F.col("out_domain")).otherwise(F.col("in_domain")), borders)).where("_border is not null")
    net = reshape.signed_net(rows, [*key, "_border"], "quantity", F.col("_in"))
    names = sorted(set(borders.values()))
    return reshape.widen(net, key, "_border", "quantity", names).select(*key, *[F.col(n).alias(f"exchange_{n}_mw") for n in names])


def scheduled_generation(points: DataFrame) -> DataFrame:
    """The sum of all series; 0 is null."""
    return reshape.signed_net(on_grid(points), _key(points), "quantity", F.lit(True)).withColumnRenamed("quantity", "scheduled_mw")


def balancing_energy(points: DataFrame, kinds: dict[tuple[str, str], str]) -> DataFrame:
    """Prices in a column for each (business type, direction); the last wins, points without price are skipped."""
    rows = on_grid(points).where("price is not null").withColumn("_seq", _sequence())
    column = reshape.mapped(F.concat_ws("/", "business_type", "direction"), {"/".join(k): v for k, v in kinds.items()})
    names = list(kinds.values())
    return reshape.widen(rows.withColumn("_column", column).where("_column is not null"), _key(points), "_column", "price", names, "last", "_seq")


def day_ahead_prices(points: DataFrame) -> DataFrame:
    """The last price that is not null."""
    return reshape.last_known(on_grid(points).withColumn("_seq", _sequence()), _key(points), "price", "_seq", skip_null=True)


def total_of_areas(df: DataFrame, values: list[str]) -> DataFrame:
    """Sums over areas by period (and fold, where there is one), such as a country of several operators."""
    return df.groupBy("country_code", *[k for k in _KEY if k in df.columns]).agg(*[F.sum(v).alias(v) for v in values])


def plant_outages(hours: DataFrame, events: DataFrame, names: bool = False) -> DataFrame:
    """Per hour of the grid (column slot): plants, total_mw, by_fuel, a map from fuel to MW, and with names
    listed, the plants' names, cut to ten letters, with their MW. Of
    a plant's active events in the hour the latest revision counts, and of equal ones the largest.
    events: plant, fuel, active, revision, unavailable_mw, start, end, id (which breaks ties). Hours without one are there with 0."""
    touched = intervals.slots_of(events.where("active and unavailable_mw is not null"), "start", "end", "60 minutes")
    now = intervals.latest(touched, ["slot", "plant"], [F.desc("revision"), F.desc("unavailable_mw"), F.asc("id")])
    fuels = now.groupBy("slot", "fuel").agg(F.count("*").alias("plants"), F.sum("unavailable_mw").alias("mw"))
    # As many as there are plants, largest first.
    place = F.struct((-F.col("unavailable_mw")).alias("o"), F.col("plant").cast("string").alias("p"))
    said = lambda x: F.concat(F.substring(F.coalesce(x["p"], F.lit("?")), 1, 10), F.lit(":"), F.bround(-x["o"], 0).cast("long").cast("string"))
    listed = now.groupBy("slot").agg(F.array_join(F.transform(F.sort_array(F.collect_list(place)), said), ", ").alias("listed"))
    per = fuels.groupBy("slot").agg(F.sum("plants").alias("plants"), F.sum("mw").alias("total_mw"), F.map_from_entries(F.collect_list(F.struct(F.coalesce("fuel", F.lit("?")), "mw"))).alias("by_fuel"))
    out = hours.join(per.join(listed, "slot") if names else per, "slot", "left")
    return out.select(*hours.columns, F.coalesce("plants", F.lit(0)).alias("plants"), F.coalesce("total_mw", F.lit(0.0)).alias("total_mw"), "by_fuel", *([F.coalesce("listed", F.lit("")).alias("listed")] if names else []))


def settlement_prices(contracts: DataFrame, contract: str, by_minutes: dict[int, DataFrame], price: str) -> DataFrame:
    """Adds the price of each contract's delivery from the table of its duration (15 and 60 minutes,
    say); null where the duration has no table or the table no row. Tables have trade_date, time_interval."""
    prices = reshape.consolidate({k: df.select("trade_date", "time_interval", price) for k, df in by_minutes.items()}, "_minutes")
    c = contracts.withColumn("_c", T.contract(F.trim(contract)))
    label = F.concat(F.date_format("_c.start", "HH:mm"), F.lit("-"), F.date_format("_c.end", "HH:mm"))
    c = c.withColumns({"trade_date": F.to_date("_c.start"), "time_interval": label, "_minutes": F.col("_c.minutes")})
    return c.join(prices, ["trade_date", "time_interval", "_minutes"], "left").select(*contracts.columns, "trade_date", "time_interval", price)


def trade_ticks(rows: DataFrame, file: list[str], position: str, day: Column) -> DataFrame:
    """Ticks of spreadsheets' rows as text: contract, qty_mw, qty_mwh, price_eur_mwh, exec_time.
    Repeated headers and rows without a quantity (cancelled ones say SN) go; numbers that can't be
    read are null. trade_id numbers a day's remaining rows from YYYYMMDD00000; rows whose contract
    can't be read use up a number and go. A time that can't be read is the day's start."""
    numbers = {c: F.col(c).try_cast("double") for c in ("qty_mw", "qty_mwh", "price_eur_mwh")}
    kept = rows.where("contract is not null").withColumns(numbers).where("qty_mw is not null")
    index = F.row_number().over(Window.partitionBy(*file).orderBy(position)) - 1
    out = kept.withColumn("trade_id", F.date_format(day, "yyyyMMdd").cast("long") * 100000 + index).withColumn("_c", T.contract(F.trim("contract"))).where("_c is not null")
    at = F.coalesce(F.try_to_timestamp(F.trim("exec_time"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"), day.cast("timestamp_ntz"))
    return out.select(*file, "trade_id", F.trim("contract").alias("contract"), F.col("_c.start").alias("contract_start"), F.col("_c.end").alias("contract_end"), F.col("_c.minutes").alias("contract_duration"), *numbers, at.alias("exec_time"))
