from datetime import datetime

from tidewatt.sources import documents as sources


def texts(spark, *docs):
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc int, text string")


def test_attributes_of_awkward_elements(spark):
    docs = texts(
        spark,
        "<e:Env xmlns:e='urn:e'><e:Body><e:root>"
        "<e:item date='2024-01-01T00:01:00+01:00' value1='1' name=\"x &amp; 'y' &#8364;\"/>"
        "<!-- <item date='2024-01-01T00:02:00' value1='2'/> -->"
        "<e:item data-value1='7' date=\"2024-01-01T00:03:00\" value1=\"3\"><![CDATA[<item date='2024-01-01T00:04:00'/>]]></e:item>"
        "<e:item value1='5'/><e:item date='' value1='6'/></e:root></e:Body></e:Env>",
        "<Env><Body><root><item date='2024-01-02T00:00:00'/></root></Body></Env>", "<Env><Body><root/></Body></Env>", "<Env><Body>", "", None,
    )
    got = sources.attribute_rows(docs, "item", 1, ("name",), ("Body", "root")).orderBy("at").collect()
    assert [tuple(r) for r in got] == [(0, datetime(2024, 1, 1, 0, 1), 1.0, "x & 'y' €"), (0, datetime(2024, 1, 1, 0, 3), 3.0, None), (1, datetime(2024, 1, 2), None, None)]
    assert sorted(r["doc"] for r in sources.malformed(docs).collect()) == [3, 4]


def test_cells_and_bids_of_awkward_elements(spark):
    table = texts(spark, "<T><Row><Column type='a' id='1'>x &lt; y</Column><Column id=\"1\">second</Column><!--<Column id='2'>no</Column>--><Column id='3'><![CDATA[<Row>]]></Column><Column id='4'></Column></Row><Row/></T>")
    got = sources.column_rows(table, {"1": "a", "2": "b", "3": "c", "4": "d"}).collect()
    assert [tuple(r) for r in got if any(r)] == [("x < y", None, "<Row>", None)]
    data = texts(spark, "<m:D xmlns:m='urn:m'><m:data><m:date>2024-01-01</m:date><m:period><!-- quarter -->7</m:period><m:trade_type>B</m:trade_type><m:price> 5.5 </m:price></m:data><m:data date='2024-01-01' hour='1' trade_type='S' price='-1'/></m:D>")
    assert [tuple(r)[1:4] for r in sources.bids(data).orderBy("period", "side").collect()] == [(1, "sell", -1.0), (2, "sell", -1.0), (3, "sell", -1.0), (4, "sell", -1.0), (7, "buy", 5.5)]


def test_large_files_are_read_in_parts(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "many").mkdir()
    lines = [f"<item date='2024-01-01T{i // 60 % 24:02d}:{i % 60:02d}:00' value1=\"{i}\"><n>a &amp; b</n></item>" for i in range(6000)]
    lines[17] = "<item date='2024-01-01T00:17:00' value1='17'><n></item>"
    whole = "<?xml version='1.0'?>\n<root>\n" + "\n".join(lines) + "\n</root>\n"
    (tmp_path / "one" / "a.xml").write_text(whole)
    (tmp_path / "many" / "a.xml").write_text(whole.replace(lines[17] + "\n", "").replace("><n>", ">\n<!-- <item date='2024-01-01T00:00:00' value1='-1'/> -->\n<n>"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows, broken = sources.attribute_files(spark, str(tmp_path / "one"), "item", 1, one_line=True)
        assert rows.rdd.getNumPartitions() > 3
        assert sorted(r["value1"] for r in rows.collect()) == [float(i) for i in range(6000) if i != 17]
        assert ["value1='17'" in r["broken"] for r in broken.collect()] == [True]
        rows, broken = sources.attribute_files(spark, str(tmp_path / "many"), "item", 1)
        assert sorted(r["value1"] for r in rows.collect()) == [float(i) for i in range(6000) if i != 17]
        assert broken.collect() == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_documents_are_parsed_once(spark):
    outage = "<D><TimeSeries/><TimeSeries><mRID>2</mRID><Available_Period/><Available_Period><timeInterval><start>2024-01-01T05:00Z</start></timeInterval><Point><quantity>3</quantity></Point><Point><quantity>2</quantity></Point></Available_Period></TimeSeries></D>"
    docs = texts(spark, outage, "<D/>", "<D>", None)
    point = "<D><TimeSeries><Period><Point><position>1</position></Point></Period></TimeSeries></D>"
    found = {
        "outages": sources.outages(docs), "points": sources.curve_points(texts(spark, point)), "items": sources.attribute_rows(docs, "item", 1),
        "hours": sources.columnar_json(texts(spark, '{"hourly": {"time": ["2024-01-01T00:00"], "v": [1.5]}}'), "hourly", ["v"]),
    }
    few = {"outages": ["doc", "min_available_mw"], "points": ["series", "at"], "items": ["doc", "value1"], "hours": ["v"]}
    for name, rows in found.items():
        plan = rows.select(*few[name])._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_xml(") + plan.count("from_json(") == 1, name
    got = [(r["doc"], r["timeseries_mrid"], r["min_available_mw"], r["points"]) for r in found["outages"].collect()]
    assert [(d, m) for d, m, *_ in got] == [(0, None), (0, "2")] and got[1][2:] == (None, None)
    whole = sources.outages(texts(spark, outage.replace("<Available_Period/>", ""))).where("timeseries_mrid is not null").first()
    assert (whole["min_available_mw"], [(p["position"], p["available_mw"], p["point_start"].hour) for p in whole["points"]]) == (2.0, [(1, 3.0, 5), (2, 2.0, 5)])
    assert [r["v"] for r in found["hours"].collect()] == [1.5] and found["points"].count() == 1
