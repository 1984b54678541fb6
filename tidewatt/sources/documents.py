"""Semi-structured market documents as rows: XML, JSON, CSV and spreadsheets.

Readers take a DataFrame with a column of document text (``read_documents`` makes one), so that
parsing is one narrow step of the plan; only spreadsheets need Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.functions.timegrid import clock_seconds, duration_minutes
from tidewatt.operators.reshape import mapped, point_time

_POINT = "position INT, quantity DOUBLE, secondaryQuantity DOUBLE, `price.amount` DOUBLE, `imbalance_Price.amount` DOUBLE, `imbalance_Price.category` STRING, `activation_Price.amount` DOUBLE, Financial_Price ARRAY<STRUCT<amount DOUBLE, `priceDescriptor.type` STRING>>"
_PERIOD = f"timeInterval STRUCT<start: STRING, `end`: STRING>, resolution STRING, Point ARRAY<STRUCT<{_POINT.replace(' INT', ': INT').replace(' DOUBLE', ': DOUBLE').replace(' STRING', ': STRING').replace(' ARRAY', ': ARRAY')}>>"
_SERIES = f"mRID STRING, businessType STRING, `flowDirection.direction` STRING, `in_Domain.mRID` STRING, `out_Domain.mRID` STRING, `currency_Unit.name` STRING, curveType STRING, MktPSRType STRUCT<psrType: STRING>, Period ARRAY<STRUCT<{_PERIOD.replace('timeInterval STRUCT', 'timeInterval: STRUCT').replace('resolution STRING', 'resolution: STRING').replace('Point ARRAY', 'Point: ARRAY')}>>"
#: Types of the parts of an imbalance price to output columns.
PRICE_PARTS = {"A01": "scarcity", "A02": "incentive", "A03": "financial_neutrality"}
#: Generation types to output columns.
GENERATION = {
    "B01": "biomass", "B02": "coal", "B04": "gas", "B05": "coal", "B10": "hydro_pumped", "B11": "hydro_other", "B12": "hydro_other",
    "B14": "nuclear", "B16": "solar", "B18": "wind_offshore", "B19": "wind",
}


def read_documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, modified, text of whole files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), F.decode("content", "UTF-8").alias("text"))


def file_day(path: Column) -> Column:
    """The date in a file's name, written YYYYMMDD, YYYY-MM-DD, YYYY_MM_DD or DD_MM_YYYY."""
    name = F.substring_index(path, "/", -1)
    iso = F.try_to_timestamp(F.regexp_replace(F.regexp_extract(name, r"(\d{4}[-_]?\d{2}[-_]?\d{2})", 1), "[-_]", ""), F.lit("yyyyMMdd")).cast("date")
    other = F.try_to_timestamp(F.regexp_extract(name, r"(\d{2}_\d{2}_\d{4})", 1), F.lit("dd_MM_yyyy")).cast("date")
    return F.coalesce(iso, other)


def _xml(text: Column, columns: str) -> Column:
    """The named parts of a document's root, without namespaces; others are left out."""
    return F.from_xml(text, columns, {"ignoreNamespace": "true"})


def _each(df: DataFrame, kept: list, array: Column | str, name: str, position: str | None = None) -> DataFrame:
    """kept, and a row for each element of the array. The outer form, since of explode Spark makes a filter
    on the array's size, below which a document would be parsed again for each mention of it."""
    at = position or "_i"
    rows = df.select(*kept, F.posexplode_outer(array).alias(at, name)).where(F.col(at).isNotNull())
    return rows if position else rows.drop(at)


def _elements(docs: DataFrame, path: tuple[str, ...], kind: str) -> DataFrame:
    """docs without text, with _r, a row for each element at the path below the root."""
    *above, tag = path
    schema = f"`{tag}`: ARRAY<STRUCT<{kind}>>"
    for name in reversed(above):
        schema = f"`{name}`: STRUCT<{schema}>"
    parsed = docs.withColumn("_d", _xml(F.col("text"), schema.replace(": ", " ", 1)))
    found = F.col("_d")
    for name in path:
        found = found[name]
    return _each(parsed, [c for c in docs.columns if c != "text"], found, "_r")


def malformed(docs: DataFrame, column: str = "text") -> DataFrame:
    """The documents that are no well-formed XML, which the readers take no or few rows from."""
    told = F.from_xml(F.col(column), "_broken STRING", {"columnNameOfCorruptRecord": "_broken"})["_broken"]
    return docs.where(F.col(column).isNotNull() & (told.isNotNull() | (F.trim(column) == "")))


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str, one_line: bool = False) -> DataFrame:
    """The elements of that tag, at any depth, of files of any size, with broken, the text of an element that
    can't be read, whose other columns are null. A file is read element by element, in one task; with
    one_line, where each element stands on a line of its own, the parts of a large file go to many tasks."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("multiLine", str(not one_line).lower()).option("columnNameOfCorruptRecord", "broken").option("ignoreNamespace", "true")
    rows = reader.schema(f"{schema}, broken STRING").load(path)
    # Lines around the elements, such as the root's own, are no broken elements.
    return rows.where(F.col("broken").isNull() | F.col("broken").rlike(rf"<(\w+:)?{row_tag}\b")) if one_line else rows


def attribute_rows(docs: DataFrame, row_tag: str, values: int, texts: tuple[str, ...] = (), within: tuple[str, ...] = ()) -> DataFrame:
    """at, value1..valueN and the texts of elements that carry a date and numbered values as
    attributes; rows whose date can't be read are dropped, values that can't are null. within: the
    elements between the root and the rows."""
    names = ["date", *[f"value{k}" for k in range(1, values + 1)], *texts]
    rows = _elements(docs, (*within, row_tag), ", ".join(f"`_{n}`: STRING" for n in names))
    return _dated(rows.select(*[c for c in docs.columns if c != "text"], *[F.col("_r")[f"_{n}"].alias(f"_{n}") for n in names]), values, texts)


def attribute_files(spark: SparkSession, path: str, row_tag: str, values: int, texts: tuple[str, ...] = (), one_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """As attribute_rows of all files at path, and the texts of elements that can't be read."""
    names = ["date", *[f"value{k}" for k in range(1, values + 1)], *texts]
    rows = xml_rows(spark, path, row_tag, ", ".join(f"`_{n}` STRING" for n in names), one_line)
    return _dated(rows.where("broken is null").drop("broken"), values, texts), rows.where("broken is not null").select("broken", F.col("_date").alias("date"))


def _dated(rows: DataFrame, values: int, texts: tuple[str, ...]) -> DataFrame:
    at = F.try_to_timestamp(F.replace(F.substring("_date", 1, 19), F.lit("T"), F.lit(" "))).cast("timestamp_ntz")
    kept = [c for c in rows.columns if not c.startswith("_")]
    numbers = [F.col(f"_value{k}").try_cast("double").alias(f"value{k}") for k in range(1, values + 1)]
    return rows.select(*kept, at.alias("at"), *numbers, *[F.col(f"_{t}").alias(t) for t in texts]).where("at is not null")


def column_rows(docs: DataFrame, names: dict[str, str], within: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose cells are <Column id="k">v</Column>; names: id -> output name. Of cells that share
    an id the first counts; an empty one is null."""
    rows = _elements(docs, (*within, "Row"), "Column: ARRAY<STRUCT<_id: STRING, _VALUE: STRING>>")
    cell = lambda k: F.nullif(F.get(F.filter("_r.Column", lambda c: c["_id"] == k), F.lit(0))["_VALUE"], F.lit(""))
    return rows.select(*[cell(k).alias(v) for k, v in names.items()])


def curve_points(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """A row for each point of each period of each time series: series attributes, start of the
    point, position, resolution in minutes, values, and how many positions the period has."""
    parsed = docs.withColumn("_d", _xml(F.col("text"), f"docStatus STRUCT<value: STRING>, TimeSeries ARRAY<STRUCT<{_nested(_SERIES)}>>"))
    kept = [c for c in docs.columns if c != "text"]
    # A document has one currency, that of its first series.
    told = [F.coalesce("_d.docStatus.value", F.lit("A01")).alias("doc_status"), F.get("_d.TimeSeries", F.lit(0))["currency_Unit.name"].alias("currency")]
    series = _each(parsed, [*kept, *told], "_d.TimeSeries", "_s", "series")
    kept = [*kept, "doc_status", "currency"]
    periods = series.select(*kept, "series", "_s", F.posexplode("_s.Period").alias("part", "_p"))
    points = periods.select(*kept, "series", "part", "_s", "_p", F.explode("_p.Point").alias("_x"))
    at = lambda c: F.try_to_timestamp(F.replace(F.replace(c, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit("")), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")
    minutes = duration_minutes(F.col("_p.resolution"))
    start = at(F.col("_p.timeInterval.start"))
    length = ((clock_seconds(at(F.col("_p.timeInterval.end"))) - clock_seconds(start)) / 60 / minutes).cast("int")
    return points.select(
        *kept, "series", "part", F.col("_s.businessType").alias("business_type"), F.col("_s")["flowDirection.direction"].alias("direction"),
        F.col("_s")["in_Domain.mRID"].alias("in_domain"), F.col("_s")["out_Domain.mRID"].alias("out_domain"), F.col("_s.MktPSRType.psrType").alias("psr_type"), minutes.alias("resolution"), length.alias("length"),
        start.alias("period_start"), point_time(start, F.col("_x.position"), minutes).alias("at"), F.col("_x.position").alias("position"),
        F.col("_x.quantity").alias("quantity"), F.col("_x.secondaryQuantity").alias("difference"),
        F.coalesce(F.col("_x")["imbalance_Price.amount"], F.col("_x")["price.amount"], F.col("_x")["activation_Price.amount"]).alias("price"), F.col("_x")["imbalance_Price.category"].alias("category"),
        *[_price_part(F.col("_x.Financial_Price"), k).alias(name) for k, name in PRICE_PARTS.items()],
    )


def _price_part(parts: Column, kind: str) -> Column:
    """The last amount of the kind, null without one."""
    return F.try_element_at(F.filter(parts, lambda x: x["priceDescriptor.type"] == kind), F.lit(-1))["amount"]


def _nested(columns: str) -> str:
    """Top-level 'name TYPE' pairs as struct members."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(columns + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            name, kind = columns[start:i].strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            start = i + 1
    return ", ".join(out)


def bids(docs: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Bids of a matching-curve document. Rows of hours are repeated for their four quarters;
    unknown sides are dropped."""
    rows = attribute_or_child(docs, "data", ("date", "period", "hour", "time_interval", "price", "energy_order", "energy_match", "trade_type", "order_resolution"), within)
    side = mapped(F.col("trade_type"), {"B": "buy", "S": "sell"})
    hourly = F.col("period").isNull() & F.col("hour").isNotNull()
    rows = rows.withColumn("_q", F.explode(F.when(hourly, F.sequence(F.lit(1), F.lit(4))).otherwise(F.array(F.lit(0)))))
    number = F.when(hourly, (F.col("hour").try_cast("int") - 1) * 4 + F.col("_q")).otherwise(F.col("period").try_cast("int"))
    resolution = F.coalesce(mapped(F.col("order_resolution"), {"PT15M": "15min", "PT60M": "60min"}), F.when(hourly, "60min").otherwise("15min"))
    return rows.select(F.col("date").try_cast("date").alias("delivery_date"), number.alias("period"), side.alias("side"), *[F.col(c).try_cast("double").alias(n) for c, n in (("price", "price"), ("energy_order", "volume_bid"), ("energy_match", "volume_matched"))], resolution.alias("order_resolution")).where("side is not null and period is not null")


def attribute_or_child(docs: DataFrame, tag: str, names: tuple[str, ...], within: tuple[str, ...] = ()) -> DataFrame:
    """Elements by tag, with values from attributes or child elements; null where neither is."""
    rows = _elements(docs, (*within, tag), ", ".join(f"`_{n}`: STRING, `{n}`: STRING" for n in names))
    value = lambda n: F.coalesce(F.nullif(F.col("_r")[f"_{n}"], F.lit("")), F.nullif(F.trim(F.col("_r")[n]), F.lit("")))
    return rows.select(*[value(n).alias(n) for n in names])


def columnar_json(docs: DataFrame, field: str, columns: list[str]) -> DataFrame:
    """{field: {"time": [...], column: [...]}} as rows."""
    kind = f"{field} STRUCT<time: ARRAY<STRING>, {', '.join(f'{c}: ARRAY<DOUBLE>' for c in columns)}>"
    parsed = docs.withColumn("_j", F.from_json("text", kind))
    kept = [c for c in docs.columns if c != "text"]
    rows = _each(parsed, kept, F.arrays_zip(*[F.col(f"_j.{field}.{c}").alias(c) for c in ("time", *columns)]), "_r")
    return rows.select(*kept, F.try_to_timestamp(F.replace("_r.time", F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz").alias("at"), *[F.col(f"_r.{c}").alias(c) for c in columns])


def current_json(docs: DataFrame, field: str, columns: list[str]) -> DataFrame:
    """{field: {"time": ..., column: ...}} as a row."""
    parsed = docs.withColumn("_j", F.from_json("text", f"{field} STRUCT<time: STRING, {', '.join(f'{c}: DOUBLE' for c in columns)}>")[field])
    at = F.try_to_timestamp(F.replace("_j.time", F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")
    return parsed.select(*[c for c in docs.columns if c != "text"], at.alias("at"), *[F.col(f"_j.{c}").alias(c) for c in columns])


def rate(text: Column, currency: str = "EUR", amount: int = 1) -> Column:
    """The rate of a currency in {"rates": [{"currencyCode", "amount", "rate"}]}."""
    rates = F.from_json(text, "rates ARRAY<STRUCT<currencyCode: STRING, amount: INT, rate: DOUBLE>>")["rates"]
    return F.get(F.filter(rates, lambda r: (r["currencyCode"] == currency) & (r["amount"] == amount)), F.lit(0))["rate"]


def table_csv(spark: SparkSession, path: str, drop: tuple[str, ...] = ("id", "created_at")) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True).drop(*drop)


def cells(files: DataFrame, schema: str, header: str | int, columns: list[str]) -> DataFrame:
    """Rows of the first sheet of Excel files (path, content). header: the row's number, or a cell
    text by which it is found. Needs an Excel engine of pandas on the workers."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for batch in batches:
            for content in batch["content"]:
                sheet = pd.read_excel(io.BytesIO(content), header=None)
                at = header if isinstance(header, int) else next(i for i, row in sheet.iterrows() if header in row.astype(str).tolist())
                yield located(sheet, at, columns)

    return files.select("content").mapInPandas(read, schema)


def located(sheet: pd.DataFrame, at: int, columns: list[str]) -> pd.DataFrame:
    """The named columns below the header row, with empty rows left out."""
    names = [str(x).strip() for x in sheet.iloc[at]]
    body = sheet.iloc[at + 1 :].dropna(how="all")
    return pd.DataFrame({c: body.iloc[:, names.index(c)].to_numpy() if c in names else None for c in columns})


def located_two_levels(sheet: pd.DataFrame, at: int, columns: dict[str, tuple[str, str]]) -> pd.DataFrame:
    """Columns by their group (in row ``at``, over its columns or merged over several) and name (in
    the row below it); rows without a value in the first column are left out."""
    groups = sheet.iloc[at].ffill().fillna("").astype(str).str.strip()
    names = sheet.iloc[at + 1].fillna("").astype(str).str.strip()
    where = {pair: i for i, pair in reversed([*enumerate(zip(groups, names, strict=True))])}
    body = sheet.iloc[at + 2 :]
    out = pd.DataFrame({c: body.iloc[:, where[pair]].to_numpy() if pair in where else None for c, pair in columns.items()})
    return out[out.iloc[:, 0].notna()].reset_index(drop=True)


_OUTAGE_SERIES = (
    "mRID: STRING, businessType: STRING, curveType: STRING, `biddingZone_Domain.mRID`: STRING, `quantity_Measure_Unit.name`: STRING, `production_RegisteredResource.mRID`: STRING,"
    " `production_RegisteredResource.name`: STRING, `production_RegisteredResource.location.name`: STRING, `production_RegisteredResource.pSRType.psrType`: STRING,"
    " `production_RegisteredResource.pSRType.powerSystemResources.nominalP`: DOUBLE, `start_DateAndOrTime.date`: STRING, `start_DateAndOrTime.time`: STRING,"
    " `end_DateAndOrTime.date`: STRING, `end_DateAndOrTime.time`: STRING, Reason: ARRAY<STRUCT<code: STRING, text: STRING>>,"
    " Available_Period: ARRAY<STRUCT<timeInterval: STRUCT<start: STRING, `end`: STRING>, resolution: STRING, Point: ARRAY<STRUCT<position: INT, quantity: DOUBLE>>>>"
)
_OUTAGE = f"mRID STRING, revisionNumber INT, type STRING, `process.processType` STRING, createdDateTime STRING, docStatus STRUCT<value: STRING>, Reason ARRAY<STRUCT<code: STRING, text: STRING>>, TimeSeries ARRAY<STRUCT<{_OUTAGE_SERIES}>>"


def _utc(text: Column) -> Column:
    """The instant of '2024-01-01T00:00Z' or '2024-01-01T00:00:00Z', without a zone."""
    plain = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return F.coalesce(F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm")), F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss"))).cast("timestamp_ntz")


def outages(docs: DataFrame) -> DataFrame:
    """An event for each time series of an outage document: nominal power and the least available
    quantity over all its points, with the points numbered on over the periods, whose times they
    carry. Without a status a document is active (A05); a series without a reason has its
    document's. max_unavailable_mw may be negative, and is null without a nominal or available power."""
    parsed = docs.withColumn("_d", _xml(F.col("text"), _OUTAGE))
    kept = [c for c in docs.columns if c != "text"]
    rows = _each(parsed, [*kept, "_d"], "_d.TimeSeries", "_s")
    of = lambda name: F.col("_s")[name]
    times = lambda p: (_utc(p["timeInterval"]["start"]).alias("point_start"), _utc(p["timeInterval"]["end"]).alias("point_end"), p["resolution"].alias("resolution"))
    # Times are read once for a period, not for each of its points.
    periods = F.transform("_s.Available_Period", lambda p: F.struct(F.struct(*times(p)).alias("t"), p["Point"].alias("x")))
    points = F.flatten(F.transform(periods, lambda p: F.transform(p["x"], lambda x: F.struct(*[p["t"][c].alias(c) for c in ("point_start", "point_end", "resolution")], x["quantity"].alias("available_mw")))))
    least = F.array_min(F.flatten(F.transform("_s.Available_Period", lambda p: p["Point"]["quantity"])))
    nominal = of("production_RegisteredResource.pSRType.powerSystemResources.nominalP")
    end = lambda side: _utc(F.concat(of(f"{side}_DateAndOrTime.date"), F.lit("T"), F.coalesce(of(f"{side}_DateAndOrTime.time"), F.lit("00:00Z"))))
    reason = lambda part: F.coalesce(F.get("_s.Reason", F.lit(0))[part], F.get("_d.Reason", F.lit(0))[part])
    return rows.select(
        *kept, F.col("_d.mRID").alias("doc_mrid"), F.coalesce("_d.revisionNumber", F.lit(0)).alias("revision_number"), F.col("_s.mRID").alias("timeseries_mrid"),
        F.col("_d.type").alias("doc_type"), of("businessType").alias("business_type"), F.coalesce("_d.docStatus.value", F.lit("A05")).alias("doc_status"), F.col("_d")["process.processType"].alias("process_type"),
        _utc(F.col("_d.createdDateTime")).alias("created_datetime"), of("biddingZone_Domain.mRID").alias("bidding_zone"),
        of("production_RegisteredResource.mRID").alias("unit"), of("production_RegisteredResource.name").alias("unit_name"), of("production_RegisteredResource.location.name").alias("location_name"),
        of("production_RegisteredResource.pSRType.psrType").alias("psr_type"), of("quantity_Measure_Unit.name").alias("quantity_unit"), of("curveType").alias("curve_type"),
        end("start").alias("unavail_start"), end("end").alias("unavail_end"),
        nominal.alias("nominal_mw"), least.alias("min_available_mw"), (nominal - least).alias("max_unavailable_mw"), reason("code").alias("reason_code"), reason("text").alias("reason_text"),
        F.transform(points, lambda p, i: p.withField("position", i + 1)).alias("points"),
    )
