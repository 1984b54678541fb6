from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatt.operators import intervals, upsert
from tidewatt.streaming import live

VERSIONS = "unit long, revision int, created timestamp, status string, ends timestamp, n int"


def versions():
    day = lambda d, h=0: datetime(2024, 1, d, h)
    return [
        (1, 1, day(1), "A05", day(20), 0), (1, 2, day(2), "A05", day(20), 1), (1, 3, day(3), "A09", day(20), 2), (2, 5, day(1), "A05", day(21), 3),
        (2, 4, day(5), "A05", day(21), 4), (3, None, None, "A05", day(22), 5), (3, None, day(1), "A09", day(22), 6), (4, 1, day(4), "A13", None, 7), (4, 1, day(4), "A13", None, 7),
    ]


@pytest.mark.parametrize("seed", [0, 1])
def test_supersession_in_any_order(spark, tmp_path, seed):
    df = spark.createDataFrame(versions(), VERSIONS)
    order = [("created", True), ("revision", True), ("n", False)]
    stream = live.replayed(df, str(tmp_path / "in"), 5, F.concat(F.lit(str(seed)), F.col("n").cast("string"), F.col("status")))
    out = live.emptied(live.superseding(stream, ["unit"], order, "ends", "ends", "90 days"), str(tmp_path / "out"), str(tmp_path / "check"))
    last = out.groupBy("unit").agg(F.max_by(F.struct(*df.columns), "batch").alias("r")).select("r.*")
    want = intervals.latest(df, ["unit"], [F.desc_nulls_last("created"), F.desc_nulls_last("revision"), "n"])
    assert sorted(map(tuple, last.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert out.where("unit = 1").orderBy("batch").collect()[-1]["status"] == "A09"


def test_state_of_ended_keys_is_dropped(spark, tmp_path):
    """A version of a key that ended long ago is known no more, and starts anew."""
    rows = versions()[:1] + [(9, 1, datetime(2024, 6, 1), "A05", datetime(2024, 6, 2), 8), (9, 2, datetime(2024, 6, 1), "A05", datetime(2024, 6, 3), 9), (1, 0, datetime(2023, 12, 1), "A05", datetime(2024, 6, 4), 10)]
    (tmp_path / "in").mkdir()
    for i, r in enumerate(rows):
        spark.createDataFrame([r], VERSIONS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(VERSIONS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = live.emptied(live.superseding(stream, ["unit"], [("created", True)], "ends", "ends", "0 days"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert {r["n"] for r in out.where("unit = 1").collect()} == {0, 10}


def quarter(h, q, v, kind="a"):
    start = datetime(2024, 1, 1) + timedelta(hours=h, minutes=15 * q)
    return (kind, start, f"{start:%H:%M}", v)


QUARTERS = "kind string, start timestamp, time_interval string, v double"


def test_gate_waits_for_the_last_quarter(spark, tmp_path):
    files = [
        [quarter(0, 0, 1.0), quarter(0, 1, 2.0), quarter(1, 0, 9.0)], [quarter(0, 3, 4.0), quarter(0, 3, 4.0), quarter(1, 1, 9.0, "b")], [quarter(0, 2, 3.0), quarter(1, 1, 9.0)],
        [quarter(0, 2, 5.0)], [quarter(40, 0, 0.0)], [quarter(80, 0, 0.0)], [quarter(1, 2, 9.0), quarter(1, 3, 9.0)], [],
    ]
    for i, f in enumerate(files):
        spark.createDataFrame(f, QUARTERS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(QUARTERS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = live.emptied(live.gated_hours(stream, ["kind"], "start", ["v"], "6 hours"), str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted((r["batch"], r["kind"], r["hour_start"].hour, r["time_interval"], r["v"]) for r in out.collect())
    first, again = [g[1:] for g in got[:4]], [g[1:] for g in got[4:]]
    assert first == [("a", 0, "00:00", 1.0), ("a", 0, "00:15", 2.0), ("a", 0, "00:30", 3.0), ("a", 0, "00:45", 4.0)]
    assert again == [("a", 0, "00:00", 1.0), ("a", 0, "00:15", 2.0), ("a", 0, "00:30", 5.0), ("a", 0, "00:45", 4.0)]  # hour 1 came too late


ROWS = "day date, k long, v string, n int"


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda d: date(2024, 1, d)
    base = [(day(d), k, f"{d}.{k}", 0) for d in (1, 2, 3) for k in range(3)] + [(None, 7, "none", 0)]
    df = lambda rows: spark.createDataFrame(rows, ROWS)
    assert len(upsert.merge_partitions(path, df(base), ["day", "k"], ["day"])) == 4
    before = files(path)
    source = df([(day(2), 1, "new", 1), (day(2), 1, "newer", 2), (day(2), 9, "added", 1), (day(5), 1, "day", 1)])
    assert upsert.merge_partitions(path, source, ["day", "k"], ["day"], "n") == [(day(2),), (day(5),)]
    want = sorted([r for r in base if r[:2] != (day(2), 1)] + [(day(2), 1, "newer", 2), (day(2), 9, "added", 1), (day(5), 1, "day", 1)], key=repr)
    read = lambda: sorted((tuple(r) for r in spark.read.schema(ROWS).parquet(path).select("day", "k", "v", "n").collect()), key=repr)
    assert read() == want
    after = files(path)
    assert all(after[f] == t for f, t in before.items() if "day=2024-01-02" not in f) and not any("day=2024-01-02" in f and f in after for f in before)
    upsert.merge_partitions(path, source, ["day", "k"], ["day"], "n")
    assert read() == want

    def fails(target, new):
        bad = F.udf(lambda x: 1 // 0, "int")
        return target.unionByName(new).withColumn("n", bad("n"))

    with pytest.raises(Exception):
        upsert.rewrite_partitions(path, source, ["day"], fails)
    assert read() == want
    with pytest.raises(ValueError):
        upsert.merge_partitions(path, source, ["k"], ["day"])
    times = files(path)
    same = df([(day(1), 0, "1.0", 5), (day(3), 0, "other", 5)])
    assert upsert.merge_changed_partitions(path, same, ["day", "k"], ["v"], {}, ["day"]) == [(day(3),)]
    assert {f for f, t in files(path).items() if times.get(f) != t and "2024-01-03" not in f} == set()
    upsert.replace_days_partitioned(path, df([(day(2), 4, "x", 0), (day(9), 4, "outside", 0)]), "day", day(2), day(3))
    assert sorted((r[0].day if r[0] else 0, r[1]) for r in read()) == [(0, 7), (1, 0), (1, 1), (1, 2), (2, 4), (5, 1)]
    assert upsert.merge_partitions(path, df([]), ["day", "k"], ["day"]) == []


def test_pruned_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(date(2024, 1, 1 + i % 3), "AB"[i % 2], i) for i in range(12)], "day date, area string, v int").write.partitionBy("day", "area").parquet(path)
    plan = upsert.in_partitions(spark.read.parquet(path), ["day", "area"], [(date(2024, 1, 1), "A"), (date(2024, 1, 2), "B")])
    assert sorted(r["v"] for r in plan.collect()) == [0, 1, 6, 7]
    assert all(f"{c}#" in plan._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0] for c in ("day", "area"))


def test_streams_touch_partitions(spark, tmp_path):
    rows = [(date(2024, 1, 1 + i % 4), i % 6, f"v{i}", i) for i in range(40)]
    stream = live.replayed(spark.createDataFrame(rows, ROWS), str(tmp_path / "in"), 4, F.col("n"), 2)
    live.upserting(stream, str(tmp_path / "t"), ["day", "k"], "n", str(tmp_path / "c"), ["day"]).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "t")).groupBy("day", "k").count().where("count > 1").count()
    assert got == 0 and spark.read.parquet(str(tmp_path / "t")).count() == len({(r[0], r[1]) for r in rows})


def test_replayed_files_in_parts(spark, tmp_path):
    df = spark.range(400).withColumnRenamed("id", "n")
    live.replayed(df, str(tmp_path / "in"), 2, F.col("n"), 1, 4)
    assert len([p for p in (tmp_path / "in").iterdir() if p.name.startswith("part-")]) == 8
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "in")).collect()) == list(range(400))


def test_a_supersession_asks_the_state_for_what_it_needs():
    from types import SimpleNamespace

    from pyspark.sql import Row
    from pyspark.sql import types as T

    calls = []

    class State:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

        def clear(self):
            self.held = None

    state, timers = State(), set()
    handle = SimpleNamespace(getValueState=lambda *_: state, registerTimer=lambda t: (calls.append("timer"), timers.add(t)))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType()), T.StructField("at", T.LongType())])
    p = live.Supersession(schema, [("v", True)], "at", 0)
    p.init(handle)
    mark = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    give = lambda v, at: [tuple(r) for r in p.handleInputRows((1,), iter([Row(k=1, v=v, at=at, _mark=None)]), mark)]
    assert give(1, 5000) == [(1, 1, 5000)] and give(2, 9000) == [(1, 2, 9000)] and give(1, 7000) == []
    assert calls == ["get", "update", "timer", "get", "update", "timer", "get"]
    expired = lambda t: list(p.handleExpiredTimer((1,), mark, SimpleNamespace(getExpiryTimeInMs=lambda: t)))
    assert sorted(timers) == [5, 9] and expired(5) == [] and state.held == (1, 2, 9000)
    assert expired(9) == [] and state.held is None
