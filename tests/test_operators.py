from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatt.functions import stats
from tidewatt.functions import timegrid as T
from tidewatt.operators import checks, intervals, orderbook, resample, reshape, upsert
from tidewatt.sources import documents as sources
from tidewatt.streaming import live


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_labels_and_numbers(spark):
    r = one(
        spark, a=T.canonical_label(F.lit("00-01")), b=T.canonical_label(F.lit("23:45 - 24:00")), c=T.hour_label(F.lit("23:45-00:00")), d=T.period_label(F.lit(96)), e=T.period_label(F.lit(96), "24:00"),
        f=T.duration_minutes(F.lit("PT1H")), g=T.duration_minutes(F.lit("P1D")), h=T.number(F.lit("1,234 567.5")), i=T.number(F.lit("-")), j=T.contract(F.lit("20260513 22:00-20260513 22:15")), k=T.contract(F.lit("x")),
    )
    assert tuple(r)[:9] == ("00:00-01:00", "23:45-00:00", "23:00-00:00", "23:45-00:00", "23:45-24:00", 60, None, 1234567.5, None)
    assert r["j"]["minutes"] == 15 and r["k"] is None


def test_wall_clock_over_both_changes(spark):
    times = [datetime(2026, 3, 29, 0, 30), datetime(2026, 3, 29, 1, 30), datetime(2026, 10, 25, 0, 30), datetime(2026, 10, 25, 1, 30)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select("t", T.to_local(F.col("t")).alias("l"), T.fold(F.col("t")).alias("f"))
    got = rows(df, "t")
    assert [x[1].hour for x in got] == [1, 3, 2, 2]
    assert [x[2] for x in got] == [False, False, False, True]


def test_downsample_keeps_a_null_last_value(spark):
    t = datetime(2024, 1, 1, 23, 46)
    df = spark.createDataFrame([(t, 1.0), (t + timedelta(minutes=2), 3.0), (t + timedelta(minutes=5), None)], "ts timestamp_ntz, v double")
    got = resample.downsample(df, "ts", {"m": ("mean", "v"), "d": ("median", "v"), "l": ("last", "v")})
    assert rows(got) == [(date(2024, 1, 1), "23:45-00:00", 2.0, 2.0, None)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 95), max_size=40))
def test_only_whole_hours_pass_the_gate(spark, quarters):
    df = spark.createDataFrame([(date(2024, 1, 1), f"{q // 4:02d}:{q % 4 * 15:02d}-x", 1.0) for q in quarters for _ in range(2)], "trade_date date, time_interval string, v double")
    whole = {h for h in range(24) if all(h * 4 + k in quarters for k in range(4))}
    assert {int(r["time_interval"][:2]) for r in resample.roll_up(df, {"v": ("sum", "v")}).collect()} == whole


def test_skew_and_vwap(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", 2.0, 0.0), ("a", 6.0, 0.0), ("b", 5.0, 2.0), ("b", 5.0, 2.0), ("b", 5.0, 0.0), ("c", 1.0, 1.0)], "k string, v double, w double")
    got = rows(df.groupBy("k").agg(stats.skew("v").alias("s"), stats.vwap("v", "w").alias("p")), "k")
    assert got[0][1] == pytest.approx(1.4578629) and got[0][2] is None
    assert got[1][1:] == (None, 5.0) and got[2][1:] == (None, 1.0)


@pytest.mark.parametrize("block", [1, 3, 400])
def test_rolling_blocks_equal_one_window(spark, block):
    df = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=d), d, float(d * 7 % 11)) for d in range(0, 60, 2)], "day date, k int, v double")
    frames = {"m": ("mean", 7), "s": ("sum", 15)}
    assert rows(resample.rolling_blocks(df, "v", "day", ["k"], frames, block), "k") == rows(resample.rolling(df, "v", ["k"], frames), "k")


BIDS = "day int, side string, price double, volume_bid double, volume_matched double, order_resolution string"


def book(spark):
    return spark.createDataFrame(
        [(1, "sell", 10.0, 5.0, 5.0, "15min"), (1, "sell", 20.0, 5.0, 5.0, "15min"), (1, "sell", 30.0, 2.0, 0.0, "60min"), (1, "sell", 30.0, 3.0, 0.0, "15min"), (1, "sell", 90.0, 1.0, 0.0, "15min"), (1, "sell", 95.0, 4.0, 4.0, "60min"),
         (1, "buy", 40.0, 9.0, 9.0, "15min"), (1, "buy", 15.0, 2.0, 0.0, "15min"), (1, "buy", -5.0, 2.0, 0.0, "15min"), (2, "sell", 1.0, 1.0, 0.0, "15min"), (3, "sell", 1.0, 1.0, 1.0, "15min")], BIDS)


def test_order_book(spark):
    prices = spark.createDataFrame([(1, 25.0), (2, 25.0)], "day int, clearing_price double")
    got = orderbook.summary(book(spark), prices, ["day"], ["order_resolution"]).collect()
    assert len(got) == 1  # no matched sell on day 2, no price on day 3
    r = got[0].asDict()
    assert (r["clearing_volume"], r["supply_next_price"], r["supply_next_volume"], r["supply_price_gap"], r["supply_volume_gap"]) == (14.0, 30.0, 3.0, 5.0, 5.0)
    assert (r["demand_next_price"], r["demand_price_gap"], r["demand_volume_gap"]) == (15.0, 10.0, 2.0)
    w = orderbook.walls(book(spark), orderbook.clearing(book(spark), prices, ["day"]), ["day"], ["order_resolution"]).first().asDict()
    assert (w["supply_mw"], w["supply_price"], w["supply_slope"]) == (5.0, 65.0, 13.0)
    assert (w["demand_mw"], w["demand_price"]) == (2.0, -30.0)
    assert w["demand_matched_mw"] is None and w["supply_matched_price"] == -15.0
    c = rows(orderbook.curve(book(spark).where("day = 1 and side = 'buy'"), ["day"], ["order_resolution"]).select("price", "volume_from", "volume_to"), F.desc("price"))
    assert c == [(40.0, 0.0, 9.0), (15.0, 9.0, 11.0), (-5.0, 11.0, 13.0)]


def test_outage_slots(spark):
    d = lambda h, m=0: datetime(2024, 1, 1, h, m)
    e = spark.createDataFrame([("u", 1, "A05", d(0), d(1), 30.0), ("u", 2, "A09", d(0, 30), d(2), 50.0), ("v", 1, None, d(0, 15), d(0, 30), -4.0)], "unit string, rev int, status string, a timestamp_ntz, b timestamp_ntz, mw double")
    grid = spark.createDataFrame([(d(0) + timedelta(minutes=15 * k),) for k in range(5)], "slot timestamp_ntz")
    got = intervals.capacity(grid, e, "a", "b", "15 minutes", "unit", [F.desc("rev")], F.coalesce(F.col("status") == "A05", F.lit(True)), F.col("mw"), {"all": F.lit(True)})
    assert [r[1:3] for r in rows(got, "slot")] == [(1, 30.0), (2, 30.0), (0, 0.0), (0, 0.0), (0, 0.0)]


def test_reshape(spark):
    p = spark.createDataFrame([("s", 2, 5, 1.5), ("s", 4, 5, 2.5)], "s string, pos int, n int, v double")
    assert [r[2] for r in rows(reshape.fill_forward(p, ["s"], "pos", "n", ["v"]), "pos")] == [0.0, 1.5, 1.5, 2.5, 2.5]
    q = spark.createDataFrame([(1, 1, None), (1, 3, 2.0)], "d int, period int, v double")
    assert [r[2] for r in rows(reshape.densify(q, ["d"], ["v"], periods=4), "period")] == [None, 0.0, 2.0, 0.0]
    w = spark.createDataFrame([(1, "x", 15, 1.0, 1), (1, "x", 15, 2.0, 2), (1, "x", 60, 9.0, 3), (1, "y", 60, 4.0, 4)], "k int, c string, res int, v double, seq int")
    f = reshape.finest(w, ["k", "c"], "res")
    assert rows(reshape.widen(f, ["k"], "c", "v", ["x", "y", "z"])) == [(1, 3.0, 4.0, None)]
    assert rows(reshape.widen(f, ["k"], "c", "v", ["x"], "first", "seq")) == [(1, 1.0)]
    n = spark.createDataFrame([(1, 5.0, True), (1, 5.0, False), (2, 3.0, False)], "k int, v double, up boolean")
    assert rows(reshape.signed_net(n, ["k"], "v", F.col("up")), "k") == [(1, None), (2, -3.0)]
    k = spark.createDataFrame([(1, 5.0, 1), (1, None, 2)], "k int, v double, seq int")
    assert rows(reshape.last_known(k, ["k"], "v", "seq")) == [(1, None)]
    assert rows(reshape.last_known(k, ["k"], "v", "seq", skip_null=True)) == [(1, 5.0)]


def test_islands_over_midnight_and_gaps(spark):
    t = datetime(2024, 1, 1, 23, 58)
    at = [t + timedelta(minutes=m) for m in (0, 1, 2, 3, 7)]
    got = rows(checks.islands(spark.createDataFrame([(x,) for x in at], "t timestamp_ntz"), "t", 60), "first")
    assert got == [(at[0], at[3], 4), (at[4], at[4], 1)]
    far = [datetime(1999, 12, 20, 23, 59) + timedelta(minutes=m) for m in range(-3000, 20000) if m not in (-2000, 15000)]
    got = rows(checks.islands(spark.createDataFrame([(x,) for x in far], "t timestamp_ntz"), "t", 60), "first")
    assert [g[2] for g in got] == [1000, 16999, 4999]
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 4),)], "d date")
    assert rows(checks.missing_dates(days, "d"), "day") == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    assert checks.missing_dates(days.limit(0), "d").count() == 0


def test_upserts(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", 1), (2, None, 1), (None, "n", 1)], "k int, v string, at int")
    s = spark.createDataFrame([(2, None, 2), (3, "c", 2), (3, "d", 3), (None, "n", 2)], "k int, v string, at int")
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(rows(upsert.merge(t, s, ["k"], "at")), key=key) == [(1, "a", 1), (2, None, 2), (3, "d", 3), (None, "n", 1), (None, "n", 2)]
    got = sorted(rows(upsert.merge_changed(t, s, ["k"], ["v"], {"at": F.lit(9)}, "at")), key=key)
    assert got == [(1, "a", 1, "same"), (2, None, 1, "same"), (3, "d", 9, "inserted"), (None, "n", 1, "same"), (None, "n", 9, "inserted")]
    assert sorted(rows(upsert.insert_absent(t, s, ["k"], "at")), key=key)[2] == (3, "d", 3)
    path = str(tmp_path / "t")
    upsert.swap_in(t, path)
    upsert.swap_in(upsert.merge(spark.read.parquet(path), s, ["k"], "at"), path)
    assert spark.read.parquet(path).count() == 5


CURVE = """<?xml version="1.0"?><D xmlns="urn:a"><TimeSeries><mRID>1</mRID><businessType>A19</businessType><Period><timeInterval><start>2024-01-01T23:00Z</start><end>2024-01-02T00:00Z</end></timeInterval><resolution>PT15M</resolution>
<Point><position>1</position><imbalance_Price.amount>5.5</imbalance_Price.amount><imbalance_Price.category>A04</imbalance_Price.category></Point><Point><position>3</position><imbalance_Price.amount>7</imbalance_Price.amount></Point></Period></TimeSeries></D>"""


def test_documents(spark):
    text = lambda x: spark.createDataFrame([(x,)], "text string")
    points = sources.curve_points(text(CURVE)).collect()
    assert [(p["position"], p["price"], p["length"], p["at"]) for p in points] == [(1, 5.5, 4, datetime(2024, 1, 1, 23)), (3, 7.0, 4, datetime(2024, 1, 1, 23, 30))]
    items = '<r><item date="2024-01-01T00:01:00+01:00" value1="1.5" value2="x"/><item date="bad" value1="2"/></r>'
    assert rows(sources.attribute_rows(text(items), "item", 2)) == [(datetime(2024, 1, 1, 0, 1), 1.5, None)]
    table = '<T><Row><Column id="1">a</Column><Column id="3">c</Column></Row></T>'
    assert rows(sources.column_rows(text(table), {"1": "x", "2": "y", "3": "z"})) == [("a", None, "c")]
    data = '<r><data date="2024-01-01" hour="2" price="5" energy_order="8" energy_match="0" trade_type="S"/><data date="2024-01-01" period="96" price="1" energy_order="2" energy_match="2" trade_type="B" order_resolution="PT60M"/><data date="2024-01-01" period="1" trade_type="?"/></r>'
    got = rows(sources.bids(text(data)), "period")
    assert [g[1] for g in got] == [5, 6, 7, 8, 96] and {g[2] for g in got} == {"sell", "buy"} and got[-1][-1] == "60min"
    weather = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "t2": [1.5, null]}}'
    assert rows(sources.columnar_json(text(weather), "hourly", ["t2"]), "at") == [(datetime(2024, 1, 1), 1.5), (datetime(2024, 1, 1, 1), None)]
    assert one(spark, r=sources.rate(F.lit('{"rates": [{"currencyCode": "USD", "amount": 1, "rate": 22}, {"currencyCode": "EUR", "amount": 1, "rate": 25.1}]}')))["r"] == 25.1
    assert one(spark, a=sources.file_day(F.lit("/x/DM_01_02_2024.xml")), b=sources.file_day(F.lit("/x/a-2024-02-03.xml")))[:] == (date(2024, 2, 1), date(2024, 2, 3))
    outage = "<D><mRID>d</mRID><revisionNumber>3</revisionNumber><TimeSeries><mRID>t</mRID><businessType>A53</businessType><production_RegisteredResource.mRID>u</production_RegisteredResource.mRID><production_RegisteredResource.pSRType.powerSystemResources.nominalP>100</production_RegisteredResource.pSRType.powerSystemResources.nominalP><Available_Period><resolution>PT60M</resolution><Point><position>1</position><quantity>40</quantity></Point></Available_Period><Available_Period><resolution>PT60M</resolution><Point><position>1</position><quantity>20</quantity></Point></Available_Period></TimeSeries></D>"
    o = sources.outages(text(outage)).first()
    assert (o["revision_number"], o["min_available_mw"], o["max_unavailable_mw"], [p["position"] for p in o["points"]]) == (3, 20.0, 80.0, [1, 2])


def test_files_and_sheets(spark, tmp_path):
    import pandas as pd

    (tmp_path / "a_20240105.xml").write_text("<x/>")
    got = sources.read_documents(spark, str(tmp_path), "*.xml").select("text", sources.file_day(F.col("path")).alias("d")).collect()
    assert [tuple(r) for r in got] == [("<x/>", date(2024, 1, 5))]
    (tmp_path / "t.csv").write_text("id,a,created_at\n1,5,x\n")
    assert rows(sources.table_csv(spark, str(tmp_path / "t.csv"))) == [(5,)]
    sheet = pd.DataFrame([["title", None], ["Period", "Price"], [1, 2.5], [None, None]])
    assert sources.located(sheet, 1, ["Price", "Period", "None"]).values.tolist() == [[2.5, 1, None]]


def test_streams(spark, tmp_path):
    t = datetime(2024, 1, 1)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(k, t + timedelta(minutes=7 * k), float(k)) for k in range(40)], "k int, ts timestamp, v double").write.parquet(source)
    stream = spark.readStream.schema("k int, ts timestamp, v double").parquet(source)
    q = live.tumbling(stream, "ts", "v", [], 15, "10 minutes").writeStream.format("memory").queryName("closed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    first = spark.table("closed").orderBy("start").first()
    assert (first["value_mean"], first["rows"]) == (1.0, 3)
    for n in (1, 2):
        live.upserting(spark.readStream.schema("k int, ts timestamp, v double").parquet(source), out, ["k"], "ts", str(tmp_path / f"u{n}")).awaitTermination(120)
    assert spark.read.parquet(out).count() == 40


def test_tables_round_half_up_and_prune(spark, tmp_path):
    from decimal import Decimal

    from tidewatt.plans.tables import TABLES

    df = spark.createDataFrame([(date(2024, 1, 1), 1, "CZ", 1.0005), (date(2024, 1, 1), 2, "DE", -1.0005)], "trade_date date, period int, country_code string, actual_load_mw double")
    TABLES["load"].write(df, str(tmp_path / "load"))
    back = spark.read.parquet(str(tmp_path / "load")).where("country_code = 'CZ'")
    assert back.first()["actual_load_mw"] == Decimal("1.001") and back.first()["area_id"] is None
    assert "PartitionFilters: [isnotnull(country_code" in back._jdf.queryExecution().toString()


def test_as_of_over_blocks(spark):
    rates = spark.createDataFrame([(date(2024, 1, 5), 1.0), (date(2024, 6, 1), None), (date(2024, 6, 2), 2.0)], "day date, rate double")
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 5),), (date(2024, 5, 1),), (date(2024, 6, 1),), (date(2025, 1, 1),)], "day date")
    for block_days in (1, 28, 10_000):
        got = intervals.as_of(days, rates, [], "day", "rate", block_days).orderBy("day").collect()
        assert [r["rate"] for r in got] == [None, 1.0, 1.0, 1.0, 2.0]


def test_islands_whatever_the_zone(spark):
    at = [datetime(2024, 3, 31, h) for h in range(5)]
    df = spark.createDataFrame([(t,) for t in at], "at timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Prague")
    try:
        assert [tuple(r) for r in checks.islands(df, "at", 3600).collect()] == [(at[0], at[-1], 5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
