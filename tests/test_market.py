from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatt.operators import resample
from tidewatt.plans import market
from tidewatt.sources import documents

T0 = datetime(2024, 1, 1)


def minutes(spark, n, *columns):
    names = ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame([(T0 + timedelta(minutes=k), *[float((k * (i + 3)) % 7) for i in range(len(columns))]) for k in range(n)], f"delivery_timestamp timestamp_ntz, {names}")


def tables(spark, n):
    return (
        minutes(spark, n, "price_afrr_plus_eur_mwh", "price_afrr_minus_eur_mwh", "price_mfrr_plus_eur_mwh", "price_mfrr_minus_eur_mwh"), minutes(spark, n, "system_imbalance_mw"),
        minutes(spark, n, "picasso_afrr_mw", "mari_mfrr_mw"), minutes(spark, n, "afrr_plus_mw", "mfrr_plus_mw"),
    )


def test_minute_features_and_gates(spark):
    rows = market.minute_features(*tables(spark, 15 + 15 + 11)).orderBy("time_interval").collect()
    assert [r["minute_count"] for r in rows] == [15, 15, 11]
    assert len(rows[0]) == 32 and rows[2]["afrr_plus_min_eur"] is None and rows[2]["minutes_at_floor"] is None
    assert rows[0]["imbalance_range_mw"] == 6.0 and rows[0]["afrr_plus_skew"] is not None
    hours = market.minute_features(*tables(spark, 119), minutes=60).collect()
    assert [(r["time_interval"], r["minute_count"]) for r in hours] == [("00:00-01:00", 60)]


def test_minute_statistics_of_touched_quarters(spark):
    m = minutes(spark, 60, "system_imbalance_mw")
    only = resample.touched_intervals(m.where(F.minute("delivery_timestamp") == 20), "delivery_timestamp")
    rows = market.minute_statistics(m, ["system_imbalance_mw"], only=only).collect()
    assert [(r["time_interval"], r["system_imbalance_last_mw"]) for r in rows] == [("00:15-00:30", float(29 * 3 % 7))]


def test_derived_features(spark):
    q = [f"{h:02d}:{m:02d}-x" for h in range(5) for m in (0, 15, 30, 45)]
    imb = spark.createDataFrame([(date(2024, 1, 1), t, float(k)) for k, t in enumerate(q)], "trade_date date, time_interval string, system_imbalance_mean_mw double")
    gen = imb.select("trade_date", "time_interval", *[F.lit(1.0 if c != "hpp_mw" else None).cast("double").alias(c) for c in market.SOURCES])
    plan = imb.select("trade_date", "time_interval", F.lit(5.0).alias("total_mw"))
    ahead = imb.select("trade_date", "time_interval", F.lit(0.25).alias("forecast_solar_mw"), F.lit("CZ").alias("country_code"))
    last = market.derived_features(imb, gen, plan, ahead).orderBy(F.desc("time_interval")).first()
    assert (last["imb_roll_2h"], last["imb_integral_4h"], last["solar_error_mw"], last["gen_total_error_mw"], last["wind_error_mw"]) == (15.5, 184.0, 0.75, 3.0, None)


@pytest.mark.parametrize("table", sorted(market.ROLL_UPS))
def test_every_roll_up_runs(spark, table):
    keys, rules = market.ROLL_UPS[table]
    columns = sorted({c for _, *cs in rules.values() for c in cs} - {"situation", "status", "currency"})
    texts = [c for c in ("situation", "status", "currency") if c in rules]
    rows = [(date(2024, 1, 1), f"07:{m:02d}-x", *["k"] * len(keys), *[float(m)] * len(columns), *["t"] * len(texts)) for m in (0, 15, 30, 45)]
    schema = "trade_date date, time_interval string, " + ", ".join([f"{k} string" for k in keys] + [f"{c} double" for c in columns] + [f"{t} string" for t in texts])
    got = market.hourly(table, spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 1 and got[0]["time_interval"] == "07:00-08:00"
    for name, (rule, *cs) in rules.items():
        if cs[0] not in texts:
            assert got[0][name] == {"mean": 22.5, "sum": 90.0, "last": 45.0, "max": 45.0, "any": 45.0, "vwap": 35.0}[rule]


KIND = "doc int, series int, part int, business_type string, direction string, in_domain string, out_domain string, psr_type string, resolution int, length int, period_start timestamp_ntz, position int, quantity double, difference double, price double, category string"


def points(spark, *rows):
    """rows of keywords; at follows from the position."""
    base = dict(doc=0, series=0, part=0, business_type=None, direction=None, in_domain=None, out_domain=None, psr_type=None, resolution=15, length=4, period_start=T0, position=1, quantity=None, difference=None, price=None, category=None)
    df = spark.createDataFrame([tuple((base | r).values()) for r in rows], KIND)
    return df.withColumn("at", F.col("period_start") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("position") - 1) * F.col("resolution")))


def test_imbalance_documents(spark):
    p = points(spark, dict(price=5.0, category="A04", position=2), dict(price=7.0, category="A05", series=1), dict(price=8.0, category="A05", series=1, position=4))
    v = points(spark, dict(quantity=3.0, direction="A02", length=2))
    rows = market.imbalance_prices(p, v).orderBy("period").collect()
    assert [r["period"] for r in rows] == [5, 6, 7, 8]  # local time is an hour ahead
    assert [r["pos_imb_price_mwh"] for r in rows] == [0.0, 5.0, 5.0, 5.0] and [r["neg_imb_price_mwh"] for r in rows] == [7.0, 7.0, 7.0, 8.0]
    assert [r["situation"] for r in rows] == ["deficit", "deficit", "surplus", "surplus"] and [r["imbalance_mwh"] for r in rows] == [3.0, 3.0, 0.0, 0.0]


def test_repeated_hour(spark):
    # 00:00 and 01:00 UTC are both 02:00 local time on 2024-10-27.
    at = [datetime(2024, 10, 27, h) for h in (0, 1)]
    two = lambda **x: points(spark, *[dict(doc=k, period_start=t, length=1, **{c: v * (k + 1) for c, v in x.items() if c in ("quantity", "price")}, **{c: v for c, v in x.items() if c not in ("quantity", "price")}) for k, t in enumerate(at)])
    def by_fold(df, value):
        return [(r["period"], r["fold"], r[value]) for r in df.orderBy("fold").collect()]

    want = [(9, False, 2.0), (9, True, 4.0)]
    flow, psr = two(quantity=2.0, in_domain="CZ", out_domain="DE"), two(quantity=2.0, psr_type="B02")
    assert by_fold(market.flows(flow, "CZ", {"DE": "de"}), "flow_de_mw") == want
    assert by_fold(market.scheduled_exchanges(flow, "CZ", {"DE": "de"}), "exchange_de_mw") == want
    assert by_fold(market.scheduled_generation(psr), "scheduled_mw") == want
    assert by_fold(market.generation(psr, {"B02": "coal"}, fold=True), "gen_coal_mw") == want
    assert by_fold(market.load(psr, psr, fold=True), "forecast_load_mw") == want
    prices = two(price=2.0, business_type="A95", direction="A01", category="A04")
    assert by_fold(market.day_ahead_prices(prices), "price") == want
    assert by_fold(market.balancing_energy(prices, {("A95", "A01"): "up"}), "up") == want
    assert by_fold(market.imbalance_prices(prices, psr), "pos_imb_price_mwh") == want == by_fold(market.imbalance_prices(prices, psr), "imbalance_mwh")
    areas = market.flows(flow, "CZ", {"DE": "de"}).withColumn("country_code", F.lit("CZ"))
    assert by_fold(market.total_of_areas(areas.unionByName(areas), ["flow_de_mw"]), "flow_de_mw") == [(9, False, 4.0), (9, True, 8.0)]


def test_parts_of_imbalance_prices(spark):
    part = lambda kind, amount: f"<Financial_Price><amount>{amount}</amount><priceDescriptor.type>{kind}</priceDescriptor.type></Financial_Price>"
    point = lambda at, price, category, parts: f"<Point><position>{at}</position><imbalance_Price.amount>{price}</imbalance_Price.amount><imbalance_Price.category>{category}</imbalance_Price.category>{parts}</Point>"
    series = lambda inner: f"<TimeSeries><Period><timeInterval><start>2024-01-01T00:00Z</start><end>2024-01-01T01:00Z</end></timeInterval><resolution>PT15M</resolution>{inner}</Period></TimeSeries>"
    text = f"<D>{series(point(1, 9, 'A04', part('A01', 1) + part('A02', 2) + part('A03', 3)) + point(3, 8, 'A04', part('A02', 5)))}{series(point(2, 7, 'A05', part('A03', 4)))}</D>"
    prices = documents.curve_points(spark.createDataFrame([(0, text)], "doc int, text string"))
    rows = market.imbalance_prices(prices, points(spark, dict(quantity=1.0, direction="A01"))).orderBy("period").collect()
    got = lambda side: [tuple(r[f"{side}_imb_{c}_mwh"] for c in ("price", "scarcity", "incentive", "financial_neutrality")) for r in rows]
    assert got("pos") == [(9.0, 1.0, 2.0, 3.0), (9.0, 1.0, 2.0, 3.0), (8.0, 0.0, 5.0, 0.0), (8.0, 0.0, 5.0, 0.0)]
    assert got("neg") == [(0.0, 0.0, 0.0, 0.0), (7.0, 0.0, 0.0, 4.0), (7.0, 0.0, 0.0, 4.0), (7.0, 0.0, 0.0, 4.0)]


def test_generation_and_flows(spark):
    kinds = {"B02": "coal", "B05": "coal", "B16": "solar"}
    p = points(spark, dict(psr_type="B02", quantity=1.0), dict(psr_type="B05", quantity=2.0, series=1), dict(psr_type="B05", quantity=50.0, resolution=60, doc=1), dict(psr_type="B99", quantity=9.0))
    assert [tuple(r) for r in market.generation(p, kinds).collect()] == [(date(2024, 1, 1), 5, 3.0, None)]
    assert market.generation(p, kinds, "first").first()["gen_coal_mw"] == 1.0
    f = points(spark, dict(in_domain="CZ", out_domain="DE", quantity=4.0), dict(in_domain="DE", out_domain="CZ", quantity=6.0, doc=1))
    assert market.flows(f, "CZ", {"DE": "de", "AT": "at"}).first()["flow_de_mw"] == -6.0
    assert market.scheduled_exchanges(f, "CZ", {"DE": "de"}).first()["exchange_de_mw"] == -2.0
    assert market.scheduled_generation(points(spark, dict(quantity=4.0), dict(quantity=-4.0, series=1))).first()["scheduled_mw"] is None


def test_prices_and_load(spark):
    p = points(spark, dict(price=4.0, business_type="A95", direction="A01"), dict(price=None, doc=1, business_type="A95", direction="A01"), dict(price=2.0, series=1, business_type="A95", direction="A02"))
    assert market.day_ahead_prices(p).first()["price"] == 2.0
    b = market.balancing_energy(p, {("A95", "A01"): "fcr_up", ("A95", "A02"): "fcr_down"}).first()
    assert (b["fcr_up"], b["fcr_down"]) == (4.0, 2.0)
    got = market.load(points(spark, dict(quantity=1.0), dict(quantity=None, doc=1)), points(spark, dict(quantity=3.0, position=2))).orderBy("period").collect()
    assert [tuple(r)[1:] for r in got] == [(5, None, None), (6, None, 3.0)]


def test_outage_documents(spark):
    resource = "production_RegisteredResource"
    series = (
        f"<TimeSeries><mRID>1</mRID><{resource}.location.name>Plant</{resource}.location.name><{resource}.pSRType.powerSystemResources.nominalP>100</{resource}.pSRType.powerSystemResources.nominalP>"
        "<start_DateAndOrTime.date>2024-01-01</start_DateAndOrTime.date><start_DateAndOrTime.time>05:00:00Z</start_DateAndOrTime.time><end_DateAndOrTime.date>2024-01-02</end_DateAndOrTime.date>{0}"
        "<Available_Period><timeInterval><start>2024-01-01T05:00Z</start><end>2024-01-01T06:00Z</end></timeInterval><resolution>PT60M</resolution><Point><position>1</position><quantity>120</quantity></Point></Available_Period>"
        "<Available_Period><timeInterval><start>2024-01-01T06:00Z</start><end>2024-01-01T07:00Z</end></timeInterval><resolution>PT60M</resolution><Point><position>1</position></Point></Available_Period></TimeSeries>"
    )
    own = "<Reason><code>B18</code><text>own</text></Reason>"
    head = "<mRID>d</mRID><Reason><code>B19</code></Reason>"
    text = f"<D>{head}{series.format('')}{series.format(own)}</D>"
    a, b = documents.outages(spark.createDataFrame([(text,)], "text string")).collect()
    assert (a["doc_status"], a["revision_number"], a["location_name"], a["max_unavailable_mw"]) == ("A05", 0, "Plant", -20.0)
    assert (a["unavail_start"], a["unavail_end"]) == (datetime(2024, 1, 1, 5), datetime(2024, 1, 2))
    assert [(p["position"], p["point_start"].hour, p["available_mw"]) for p in a["points"]] == [(1, 5, 120.0), (2, 6, None)]
    assert (a["reason_code"], a["reason_text"], b["reason_code"], b["reason_text"]) == ("B19", None, "B18", "own")


def test_plant_outages(spark):
    hour = lambda h, m=0: datetime(2024, 1, 1, h, m)
    rows = [("p", "gas", True, 1, 90.0, hour(0), hour(1), 1), ("p", "gas", True, 2, 50.0, hour(0, 30), hour(2), 2), ("p", "gas", False, 3, 10.0, hour(0), hour(2), 3), ("q", None, True, 1, 5.0, hour(1), hour(1, 5), 4), ("r", "gas", True, 1, 7.0, hour(2), hour(2), 5)]
    events = spark.createDataFrame(rows, "plant string, fuel string, active boolean, revision int, unavailable_mw double, start timestamp_ntz, end timestamp_ntz, id int")
    hours = spark.createDataFrame([(hour(h),) for h in range(3)], "slot timestamp_ntz")
    got = [tuple(r) for r in market.plant_outages(hours, events).orderBy("slot").collect()]
    assert got == [(hour(0), 1, 50.0, {"gas": 50.0}), (hour(1), 2, 55.0, {"gas": 50.0, "?": 5.0}), (hour(2), 0, 0.0, None)]


def test_areas_are_kept_apart(spark):
    both = lambda **x: points(spark, dict(doc=0, **x), dict(doc=1, **{k: v * 10 for k, v in x.items()})).withColumn("country_code", F.when(F.col("doc") == 0, "CZ").otherwise("SK"))
    got = market.load(both(quantity=1.0), both(quantity=2.0)).orderBy("country_code").collect()
    assert [(r["country_code"], r["actual_load_mw"], r["forecast_load_mw"]) for r in got] == [("CZ", 1.0, 2.0), ("SK", 10.0, 20.0)]
    prices = market.day_ahead_prices(both(price=3.0)).orderBy("country_code").collect()
    assert [r["price"] for r in prices] == [3.0, 30.0]


def test_wind_of_documents(spark):
    series = lambda kind, q: f"<TimeSeries><MktPSRType><psrType>{kind}</psrType></MktPSRType><Period><timeInterval><start>2024-01-01T00:00Z</start><end>2024-01-01T00:15Z</end></timeInterval><resolution>PT15M</resolution><Point><position>1</position>{q}</Point></Period></TimeSeries>"
    text = f"<D>{series('B19', '<quantity>4</quantity>')}{series('B18', '')}{series('B16', '<quantity>9</quantity>')}</D>"
    p = documents.curve_points(spark.createDataFrame([(0, text)], "doc int, text string"))
    assert [tuple(r)[1:] for r in market.wind(p).collect()] == [(5, 4.0, 0.0, 4.0)]


def test_two_level_headers():
    sheet = pd.DataFrame([["", "", "Total", None, "Daily market", None], ["Delivery day", "Period", "Buy (MW)", "Sell (MW)", "Buy (MW)", "Sell (MW)"], ["2024-01-01", "00:00 - 00:15", 1, 2, 3, 4], [None, None, 9, 9, 9, 9]])
    got = documents.located_two_levels(sheet, 0, {"day": ("", "Delivery day"), "buy": ("Daily market", "Buy (MW)"), "sell": ("Total", "Sell (MW)"), "none": ("Total", "x")})
    assert got.values.tolist() == [["2024-01-01", 3, 2, None]]


def test_status_and_currency_of_documents(spark):
    prices = points(spark, dict(price=4.0, category="A04"), dict(price=5.0, category="A04", doc=1), dict(price=6.0, category="A05", doc=2, position=2, length=2))
    told = prices.withColumns({"doc_status": F.when(F.col("doc") == 1, "A02").otherwise("A01"), "currency": F.when(F.col("doc") == 0, "CZK")})
    volumes = points(spark, dict(quantity=1.0, difference=0.5, direction="A02", position=6, length=6))
    got = market.imbalance_prices(told, volumes).orderBy("period").collect()
    assert got[0]["status"] == "A01" and got[2]["status"] == "A02" and got[-1]["status"] == "A01" and {r["currency"] for r in got} == {"CZK"} and len(got) == 6
    assert {r["currency"] for r in market.imbalance_prices(told.withColumn("currency", F.lit(None).cast("string")), volumes).collect()} == {"EUR"}


def test_documents_tell_status_and_currency(spark):
    series = "<TimeSeries><currency_Unit.name>{0}</currency_Unit.name><Period><timeInterval><start>2024-01-01T00:00Z</start><end>2024-01-01T00:15Z</end></timeInterval><resolution>PT15M</resolution><Point><position>1</position></Point></Period></TimeSeries>"
    texts = [f"<D xmlns='urn:d'><docStatus><value>A02</value></docStatus>{series.format('CZK')}{series.format('PLN')}</D>", "<D>" + series.replace("currency_Unit.name", "x") + "</D>"]
    got = documents.curve_points(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [(r["doc_status"], r["currency"]) for r in got] == [("A02", "CZK"), ("A02", "CZK"), ("A01", None)]


def test_plants_are_listed(spark):
    at = datetime(2024, 1, 1)
    events = spark.createDataFrame([("a long plant name", "gas", True, 1, 2.5, at, at.replace(hour=1), 1), (None, "gas", True, 1, 90.0, at, at.replace(hour=1), 2), ("b", None, True, 1, 3.5, at, at.replace(hour=1), 3)], "plant string, fuel string, active boolean, revision int, unavailable_mw double, start timestamp_ntz, end timestamp_ntz, id int")
    hours = spark.createDataFrame([(at,), (at.replace(hour=5),)], "slot timestamp_ntz")
    assert [r["listed"] for r in market.plant_outages(hours, events, names=True).orderBy("slot").collect()] == ["?:90, b:4, a long pla:2", ""]
