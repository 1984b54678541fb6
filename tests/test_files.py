import io
import random
import re
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatt.operators import intervals, quantiles
from tidewatt.plans import market_queries
from tidewatt.sources import archives, arrivals, documents, sheets


def zipped(entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in entries.items():
            z.writestr(name, content)
    return out.getvalue()


def test_members_of_awkward_archives(spark, tmp_path):
    inner = zipped({"c.xml": "<c/>", "deep.zip": zipped({"d.xml": "<d>é</d>"})})
    good = zipped({"a.xml": "<a/>", "dir/b.txt": "b", "inner.zip": inner, "bad.zip": b"PK\x03\x04 broken", "empty.zip": zipped({})})
    broken = bytearray(zipped({"x.xml": "x" * 5000, "y.xml": "<y/>"}))
    at = broken.find(b"x.xml") + 8
    broken[at : at + 12] = b"\0" * 12
    for name, content in {"good.zip": good, "broken.zip": bytes(broken), "cut.zip": good[:40], "plain.xml": b"<p/>"}.items():
        (tmp_path / name).write_bytes(content)
    found = archives.files(spark, str(tmp_path)).withColumn("file", F.substring_index("path", "/", -1)).select("file", "content")
    rows = {(r["file"], r["member"]): (None if r["content"] is None else bytes(r["content"]), r["error"]) for r in archives.members(found).collect()}
    assert rows["good.zip", "a.xml"] == (b"<a/>", None) and rows["good.zip", "dir/b.txt"][0] == b"b" and rows["good.zip", "inner.zip/c.xml"][0] == b"<c/>"
    assert rows["good.zip", "inner.zip/deep.zip/d.xml"][0] == "<d>é</d>".encode() and rows["good.zip", "bad.zip"][1].startswith("BadZipFile") and ("good.zip", "empty.zip") not in rows
    assert rows["broken.zip", "x.xml"][1] and rows["broken.zip", "y.xml"] == (b"<y/>", None)
    assert rows["cut.zip", None][1].startswith("BadZipFile") and rows["plain.xml", None] == (b"<p/>", None)
    assert sorted(r["text"] for r in archives.documents(found.where("file not like 'broken%'")).collect()) == ["<a/>", "<c/>", "<d>é</d>", "<p/>"]
    assert archives.members(spark.createDataFrame([(None, 1)], "content binary, k int")).collect() == []


def put(folder, **books):
    for name, tabs in books.items():
        (folder / f"{name}.xlsx").write_bytes(archives.workbook(tabs) if isinstance(tabs, dict) else tabs)


def test_day_ahead_sheets_of_both_layouts(spark, tmp_path):
    lead = [["Results"], [], ["24.", None, "x"]]
    hours = lead + [["Hour", "Price (EUR/MWh)", "Volume\n(MWh)", "Saldo DM", "Export", "Import"], [None, None, "Sale"], [1, 50.5, "1 000.0", -8, 4, 0], [None], ["24", None, 2, "-", 1, 1]]
    heads = ["Period", "Time interval", "15 min price\n(EUR/MWh)", "Volume\n(MWh)", "Purchase 15min products\n(MWh)", "Import\n(MWh)", "60 min price reference\n(EUR/MWh)"]
    quarters = lead + [heads, [96, " 23:45-24:00 ", 7.25, 3, 1, "2,000.5", 9], [None, "x"], [2, None, 1]]
    put(tmp_path, old={"Day & 'night'": hours}, new={"S": quarters, "T": [["Total"], [1]]}, none={"S": [["nothing"]]}, broken=b"PK\x03\x04")
    rows = archives.workbook_rows(archives.files(spark, str(tmp_path)).withColumn("file", F.regexp_extract("path", r"(\w+)\.xlsx", 1)).select("file", "content"))
    assert rows.where("error is not null").select("file").collect()[0]["file"] == "broken"
    got = {(r["file"], r["period"]): r for r in sheets.day_ahead(rows, ["file"]).collect()}
    assert sorted(got) == [("new", 96), *[("old", p) for p in (1, 2, 3, 4, 93, 94, 95, 96)]]
    r = got["old", 3]
    assert (r["time_interval"], r["price_15min_eur_mwh"], r["volume_mwh"], r["saldo_dm_mwh"], r["sale_60min_products_mwh"], r["is_15min"]) == ("00:30-00:45", 50.5, 250.0, -2.0, 250.0, False)
    assert got["old", 96]["saldo_dm_mwh"] is None and got["old", 96]["price_15min_eur_mwh"] is None and got["old", 96]["volume_mwh"] == 0.5
    r = got["new", 96]
    assert (r["time_interval"], r["price_15min_eur_mwh"], r["import_mwh"], r["saldo_dm_mwh"], r["is_15min"]) == ("23:45-00:00", 7.25, 2000.5, None, True)
    ida = sheets.intraday_auction(rows, ["file"]).collect()
    assert [(r["file"], r["period"], r["price_eur_mwh"], r["import_mwh"]) for r in ida if r["period"] == 96] == [("new", 96, None, 2000.5)]


def test_two_levels_and_ticks(spark, tmp_path):
    balance = [[None, None, "Total", None, None, None, "Daily market"], ["Delivery day", "Period", "Buy (MW)", "Sell (MW)", "Buy (MWh)", "Sell (MWh)", "Buy (MW)"], ["2024-01-05", "01:00 - 01:15", 1, 2, 3, "x", 5], ["2024-01-05", "01:00 - 01:15", 1.5, 2, 3, 4, 5], [45296, "00:00 - 00:15", 9], [None, "01:15 - 01:30", 7]]
    trades = [["a"], ["b"], [], ["head"], ["Kontrakt", "", "", "", "MW"], ["20240105 10:00-20240105 10:15", None, None, "N", 2, 0.5, "1", 3, "2024-01-05 09:00:00"], ["20240105 10:00-20240105 10:15", None, None, "N", "SN", 1, 1, 1], ["bad", None, None, None, 1, 1], [], ["20240105 10:00-20240105 11:00", None, None, None, 4, None, "SN", None, "later"]]
    put(tmp_path, balance={"S": balance}, trades={"S": trades})
    rows = archives.workbook_rows(archives.files(spark, str(tmp_path)).withColumn("file", F.regexp_extract("path", r"(\w+)\.xlsx", 1)).select("file", "content"))
    got = {(r["delivery_date"], r["period"]): r for r in sheets.trade_balance(rows, ["file"]).collect()}
    assert len(got) == 96 and {d for d, _ in got} == {date(2024, 1, 5)}
    r = got[date(2024, 1, 5), 5]
    assert (r["total_buy_mw"], r["total_sell_mwh"], r["daily_market_buy_mw"], r["intraday_market_buy_mw"]) == (1.5, 4.0, 5.0, None)
    assert got[date(2024, 1, 5), 1]["total_buy_mw"] == 9.0 and got[date(2024, 1, 5), 6]["total_buy_mw"] == 0.0 == got[date(2024, 1, 5), 6]["intraday_market_buy_mw"]
    t = sheets.ticks(rows.where("file = 'trades'"), ["file"], F.lit(date(2024, 1, 5))).orderBy("trade_id").collect()
    assert [(r["trade_id"] % 100000, r["contract_duration"], r["qty_mw"], r["price_eur_mwh"], r["exec_time"]) for r in t] == [(0, 15, 2.0, 1.0, datetime(2024, 1, 5, 9)), (2, 60, 4.0, None, datetime(2024, 1, 5))]


def test_shared_strings_and_gaps(tmp_path):
    out = io.BytesIO()
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="A" sheetId="1" r:id="q"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="q" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>one</t></si><si><r><t>t</t></r><r><t>wo</t></r><rPh><t>no</t></rPh></si></sst>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData><row r="3"><c r="B3" t="s"><v>1</v></c><c r="AB3"><v>1.50</v></c></row><row><c t="b"><v>1</v></c><c t="s"><v>0</v></c></row></sheetData></worksheet>')
    rows = list(archives.sheet_rows(out.getvalue()))
    assert rows[0][:2] == ("A", 3) and rows[0][2] == [None, "two", *[None] * 25, "1.50"] and rows[1] == ("A", 4, ["1", "one"])


def test_files_are_read_once(spark, tmp_path):
    source, table, ledger = (str(tmp_path / x) for x in ("in", "table", "ledger"))
    (tmp_path / "in").mkdir()
    write = lambda name, text: (tmp_path / "in" / name).write_text(text)
    read = lambda f: f.select("path", F.explode(F.split(F.decode("content", "UTF-8"), ",")).alias("v"))
    run = lambda n: arrivals.take_in(spark, source, table, ledger, read, n, "*.csv")
    held = lambda: sorted(r["v"] for r in spark.read.parquet(table).collect())
    assert run(0) == 0
    write("a_20240101.csv", "a1,a2")
    write("b_20240103.csv", "b1")
    write("c.txt", "no")
    assert run(1) == 2 and held() == ["a1", "a2", "b1"]
    assert run(2) == 0
    write("a_20240101.csv", "a3")
    write("d_20240102.csv", "d1")
    assert run(3) == 2 and held() == ["a3", "b1", "d1"]
    assert arrivals.latest_day(arrivals.ledger_at(spark, ledger)).first()["latest"] == date(2024, 1, 3)

    def fails(f):
        return f.select("path", F.raise_error(F.lit("no")).cast("string").alias("v"))

    write("b_20240103.csv", "b2,b3")
    with pytest.raises(Exception):
        arrivals.take_in(spark, source, table, ledger, fails, 4, "*.csv")
    assert held() == ["a3", "b1", "d1"]
    assert run(5) == 1 and held() == ["a3", "b2", "b3", "d1"] and run(6) == 0


def test_what_was_known_at_each_decision(spark):
    rng = random.Random(1)
    hour = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    versions = [(rng.choice("ab"), i, hour(a := rng.randrange(40)), hour(a + rng.randrange(0, 9)), hour(rng.randrange(60)) if i % 9 else None, rng.randrange(3), float(i) if i % 5 else None) for i in range(160)]
    asked = [(j, rng.choice("abc"), hour(rng.randrange(48)), hour(rng.randrange(60)) if j % 11 else None) for j in range(200)]
    v = spark.createDataFrame(versions, "unit string, i int, a timestamp_ntz, b timestamp_ntz, created timestamp_ntz, revision int, mw double")
    q = spark.createDataFrame(asked, "id int, unit string, slot timestamp_ntz, decided timestamp_ntz")
    got = {r["id"]: (r["i"], r["mw"]) for r in intervals.known_at(q, v, ["unit"], "slot", "decided", "a", "b", "created", ["revision", "i"], ["i", "mw"], "60 minutes").collect()}
    assert len(got) == len(asked)
    for j, unit, slot, decided in asked:
        known = [x for x in versions if x[0] == unit and x[4] is not None and decided is not None and x[4] <= decided and x[2] < slot + timedelta(hours=1) and x[3] > slot and x[2] < x[3]]
        best = max(known, key=lambda x: (x[4], x[5], x[1]), default=(None,) * 7)
        assert got[j] == (best[1], best[6])


@pytest.mark.parametrize("bins", [64, 1024])
def test_quantiles_of_awkward_groups(spark, bins):
    import numpy as np

    rng = random.Random(2)
    rows = [("a", rng.lognormvariate(0, 4)) for _ in range(300)] + [("b", 5.0)] * 50 + [("c", None), ("c", float("nan")), ("d", 1.0), ("d", float("inf")), (None, 2.0), (None, 4.0)] + [("e", x) for x in (-1.7e308, 1.7e308, 0.0, 5e-324, -1.0)] + [("f", float(rng.randrange(4))) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = {"low": 0.0, "mid": 0.5, "most": 0.95, "high": 1.0}
    got = {r["k"]: tuple(r)[1:] for r in quantiles.quantiles(df, ["k"], "v", shares, bins).collect()}
    assert set(got) == {"a", "b", "c", "d", "e", "f", None} and got["c"] == (None,) * 4 and got["d"] == (1.0,) * 4 and got["b"] == (5.0,) * 4
    for k in ("a", "f", None):
        own = sorted(v for x, v in rows if x == k)
        assert got[k] == pytest.approx([np.quantile(own, s) for s in shares.values()])
    assert got["e"][0] == -1.7e308 and got["e"][1] == 0.0 and got["e"][3] == 1.7e308
    whole = quantiles.quantiles(df.where("k = 'a'"), [], F.abs("v"), {"q": 0.3}, bins).first()["q"]
    assert whole == pytest.approx(np.quantile([v for x, v in rows if x == "a"], 0.3))
    assert quantiles.quantiles(df.limit(0), ["k"], "v", shares).collect() == []


def test_workbooks_are_read_once_in_batches_of_many_files(spark, monkeypatch):
    head, values = [["Day-Ahead Market"], [None, "x & <y>"]], [["Period", "Time interval", "Volume (MWh)"], [1, "00:00-00:15", 2.5], [2, None, 3.0]]
    layout = spark.createDataFrame([(1, "00:00-00:15", 2.5), (2, None, 3.0)], "p int, t string, v double")
    body = "".join(r["x"] for r in layout.orderBy("p").select(archives.row_xml(F.col("p"), F.col("t"), F.col("v")).alias("x")).collect())
    assert body == archives.rows_xml(values[1:])
    book = archives.workbook({"a": head + values, "b": archives.rows_xml(head + values[:1]) + body})
    monkeypatch.setattr(archives, "ROWS", 3)
    files = spark.createDataFrame([(k, bytearray(book) if k != 2 else None, [k]) for k in range(4)], "k int, content binary, beside array<int>")
    rows = archives.workbook_rows(files)
    told = sorted((r["k"], r["sheet"], r["row"], r["cells"]) for r in rows.where("beside[0] = k and error is null").collect())
    cells = [["Day-Ahead Market"], [None, "x & <y>"], ["Period", "Time interval", "Volume (MWh)"], ["1", "00:00-00:15", "2.5"], ["2", None, "3.0"]]
    assert told == [(k, sheet, i, c) for k in (0, 1, 3) for sheet in "ab" for i, c in enumerate(cells, 1)]
    prices = sheets.day_ahead(rows, ["k", "sheet"])
    assert [tuple(r) for r in prices.select("k", "sheet", "period", "volume_mwh").orderBy("k", "sheet").collect()] == [(k, s, 1, 2.5) for k in (0, 1, 3) for s in "ab"]
    plan = prices._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan and "Join" not in plan
    short = bytearray(archives.workbook({"a": "<row><c><v>1</v></c></row><row><c>"}))
    broken = archives.workbook_rows(spark.createDataFrame([(short,)], "content binary")).collect()
    assert [(r["row"], r["cells"]) for r in broken] == [(1, ["1"]), (None, None)] and "Error" in broken[1]["error"]


def test_archives_of_documents_are_opened_and_parsed_once(spark):
    outage = "<D><revisionNumber>{0}</revisionNumber><TimeSeries><mRID>s</mRID></TimeSeries></D>"
    inner = zipped({"3.xml": outage.format(3)})
    boxes = spark.createDataFrame([(i, bytearray(zipped({"1.xml": outage.format(1), "2.xml": "<D>", "in.zip": inner, "n.txt": "no"}))) for i in range(3)], "box int, content binary")
    got = documents.outages(archives.documents(boxes)).select("box", "member", "revision_number", "timeseries_mrid")
    assert sorted(tuple(r) for r in got.collect()) == [(i, m, n, "s") for i in range(3) for m, n in (("1.xml", 1), ("in.zip/3.xml", 3))]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1 and plan.count("MapInArrow") == 1 and "EvalPython" not in plan


def test_archives_are_made_of_documents_one_by_one(spark, sf, monkeypatch):
    plan = market_queries.archived_outages(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "EvalPython" not in plan and plan.count("collect_list") == 1 and plan.count("RepartitionByExpression") == 1
    monkeypatch.setattr(market_queries, "FILES", 5)
    rows = spark.createDataFrame([(b, k, i, f"{b}{k}{i};") for i in (2, 1) for k in (1, 0) for b in (2, 1, None)], "box int, l_orderkey long, n int, text string")
    files = market_queries._files(rows.coalesce(1), lambda texts: " ".join(f"{k}={t}" for k, t in texts.items()).encode())
    assert [bytes(r["content"]) for r in files.collect()] == [f"0={b}01;{b}02; 1={b}11;{b}12;".encode() for b in (None, 1, 2)]


def test_sheets_of_orders_are_made_without_groups_in_memory(spark, sf):
    plan = market_queries.sheet_ticks(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "EvalPython" not in plan and "collect_list" not in plan


def test_plain_sheets_are_read_as_parsed_ones():
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rng = random.Random(3)
    pieces = ["<row>", '<row r="4">', '<row r="9" spans="1:3">', "</row>", "<c/>", '<c r="C7"/>', '<c r="A1"><v>1</v></c>', '<c r="AB2" s="3" t="s"><v>1</v></c>', "<c><v></v></c>", '<c t="inlineStr"><is><t>é </t></is></c>', '<c t="inlineStr"><is><t xml:space="preserve"></t></is></c>']
    pieces += ['<c t="inlineStr"><v>1</v></c>', "<c><is><t>no</t></is></c>", '<c t="inlineStr"/>', "<c></c>", '<c t="s"><v>0</v></c>']
    odd = ['<c t="s"><v>x</v></c>', "<c><v>a&amp;b</v></c>", "<c><v>&</v></c>", "<c><f>1+1</f><v>2</v></c>", "<c", "x", "\n", "<!-- <c/> -->", "<c><v>a\r\nb</v></c>", "<c><v>]]></v></c>", "<c><v>\x01</v></c>", "<c><v>\uffff</v></c>", '<c t="s"><v>7</v></c>', "<row/>", '<c t="inlineStr"><is><r><t>a</t></r><rPh><t>b</t></rPh></is></c>']
    frames = [(f'<worksheet xmlns="{main}"><sheetData>', "</sheetData></worksheet>")] * 6
    frames += [(f'<?xml version="1.0" encoding="UTF-8"?>\n<worksheet xmlns="{main}"><dimension ref="A1"/><sheetData>', '</sheetData><pageMargins left="1"/></worksheet>\n'), ('<worksheet xmlns="other"><sheetData>', "</sheetData></worksheet>"), (f'<worksheet xmlns="{main}"><!-- <sheetData>', "</sheetData> --></worksheet>")]
    frames += [(f'<worksheet xmlns="{main}"><row><c><v>5</v></c></row><sheetData>', "</sheetData></worksheet>"), (f'<worksheet xmlns="{main}"><sheetData>', "</sheetData>"), (f'<?xml version="1.0" encoding="ISO-8859-1"?><worksheet xmlns="{main}"><sheetData>', "</sheetData></worksheet>")]
    quick = 0

    def parsed(xml):
        rows = []
        try:
            rows.extend(r for r in archives._parsed_rows(io.BytesIO(xml), ["one", "two"]))
        except Exception:
            return None
        return rows

    for i in range(4000):
        inside = [rng.choice(pieces[:3]) + "".join(rng.choices(pieces[4:], k=rng.randrange(5))) + "</row>" for _ in range(rng.randrange(4))]
        if i % 2:
            inside.insert(rng.randrange(len(inside) + 1), rng.choice(odd + pieces))
            inside = ["".join(inside)]
            if i % 4 == 1:
                at = rng.choice([0] + [k for k, c in enumerate(inside[0]) if c == "<"])
                inside = [inside[0][:at] + rng.choice(odd + pieces) + inside[0][at:]]
        head, tail = rng.choice(frames)
        xml = (head + "".join(inside) + tail).encode()
        simple = archives._simple_rows(xml, ["one", "two"])
        quick += simple is not None
        assert simple is None or simple == parsed(xml), xml
    assert quick > 1000


def test_rows_are_read_with_their_header(spark, sf):
    none = [["nothing"], []]
    tabs = {"a": [["x"], [" Hour ", "Price\n\n(EUR/MWh)"], [1, 2.5], [], ["Period", "y"]], "b": none, "c": [["Period", None, "Volume (MWh)"], [3, "00:30-00:45", 4]]}
    files = spark.createDataFrame([(1, bytearray(archives.workbook(tabs))), (2, bytearray(b"PK")), (3, None)], "k int, content binary")
    told = archives.workbook_tables(files, sheets.DAY_AHEAD)
    looked = sheets.below(archives.workbook_rows(files), ["k"], sheets.DAY_AHEAD)
    columns = ["k", "sheet", "row", "cells", "names"]
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()), key=str)
    assert rows(sheets.below(told, ["k"], sheets.DAY_AHEAD)) == rows(looked) and looked.count() == 4
    assert told.where("error is not null").select("k").collect()[0]["k"] == 2
    plan = market_queries.sheet_prices(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Window [") == 1 and "EvalPython" not in plan and "collect_list" not in plan


def test_code_of_day_ahead_sheets_is_compiled(spark, sf):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        told = spark._jvm.PythonSQLUtils.explainString(market_queries.sheet_prices(spark, sf)._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told)]
    assert sizes and max(sizes) < 8000  # longer methods the JVM interprets
