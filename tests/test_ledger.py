import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatt.operators import ledger

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("backward", [False, True])
def test_rows_that_frames_reach(spark, keys, backward):
    rng = random.Random(4)
    live = sorted({(rng.choice("ab") if keys else "a", START + timedelta(hours=rng.randrange(2400))) for _ in range(300)})
    stale = sorted({r for r in live if rng.random() < 0.03} | {(rng.choice("ab") if keys else "a", START + timedelta(hours=rng.randrange(2400))) for _ in range(4)})
    df = lambda rows: spark.createDataFrame(rows, "k string, start timestamp_ntz").select(*keys, "start")
    want = set()
    for kind in {k for k, _ in live}:
        own = [t for k, t in live if k == kind]
        for t in own:
            ahead = sorted((x for x in own if (x >= t if backward else x <= t)), reverse=not backward)[:6]
            edge = ahead[-1] if len(ahead) == 6 else None
            for k, s in stale:
                inside = (s >= t and (edge is None or s <= edge)) if backward else (s <= t and (edge is None or s >= edge))
                # A row that is gone counts at the next row's place.
                if k == kind and s not in own:
                    later = [x for x in own if (x < s if backward else x > s)]
                    inside = bool(later) and ((max(later) if backward else min(later)) in ahead)
                if k == kind and inside:
                    want.add((k, t))
    got = {(r["k"] if keys else "a", r["start"]) for r in ledger.reached(df(live), df(stale), keys, "start", 5, 7, backward).collect()}
    assert got == want and 0 < len(want) < len(live)


def test_ledger_entries_until_they_are_done(spark):
    t = lambda *h: spark.createDataFrame([("x", START + timedelta(hours=i)) for i in h], "k string, start timestamp_ntz")
    entered = ledger.enter(t(0, 1, 2), "hour", ["k"], 1).unionByName(ledger.enter(t(1, 1), "hour", ["k"], 2)).unionByName(ledger.enter(t(5), "day", ["k"], 1))
    hours = lambda df: sorted((r["start"].hour, r["run"]) for r in df.collect())
    assert hours(ledger.pending(entered, "hour")) == [(0, 1), (1, 2), (2, 1)]
    done = entered.unionByName(ledger.finished(ledger.pending(entered, "hour").where("hour(start) < 2"), 2))
    assert hours(ledger.pending(done, "hour")) == [(2, 1)]
    again = done.unionByName(ledger.enter(t(0), "hour", ["k"], 3))
    assert hours(ledger.pending(again, "hour")) == [(0, 3), (2, 1)] and hours(ledger.pending(again, "day")) == [(5, 1)]
    assert ledger.pending(spark.createDataFrame([], ledger.LEDGER), "hour").collect() == []


def test_only_stale_rows_are_computed(spark):
    rows = [("x", START + timedelta(minutes=5 * i), float(i)) for i in range(30)] + [("y", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    late = df.where("v in (4, 20)")
    stale = ledger.touched(late.unionByName(df.where("k = 'y'")), "ts", ["k"])
    assert sorted(r["start"].minute + 60 * r["start"].hour for r in stale.collect()) == [15, 90]
    assert [r["start"].hour for r in ledger.coarser(stale, ["k"]).orderBy("start").collect()] == [0, 1]
    bucket = F.date_trunc("hour", "ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor(F.minute("ts") / 15).cast("int") * 15)
    sums = lambda d: d.where("ts is not null").groupBy("k", bucket.alias("start")).agg(F.sum("v").alias("v"))
    old = sums(df.where("v not in (4, 20)")).withColumn("v", F.when(F.col("start") > F.lit(START), F.col("v")).otherwise(-1.0))
    out = ledger.recomputed(old, stale, ["k"], "start", lambda s: sums(ledger.only(df, s, ["k"], bucket)))
    want = {r["start"]: r["v"] for r in sums(df).collect()} | {START: -1.0}
    assert {r["start"]: r["v"] for r in out.collect()} == want
    recent = ledger.trailing(df, "ts", ["k"], F.lit(START + timedelta(hours=24, minutes=20)), 1)
    assert min(r["start"] for r in recent.collect()) == START + timedelta(minutes=15)


def test_gaps_and_refill(spark):
    table = spark.createDataFrame([("x", START), ("x", START + timedelta(hours=3)), ("y", START), ("z", None)], "k string, start timestamp_ntz")
    source = spark.createDataFrame([("x", START + timedelta(hours=1)), ("x", START + timedelta(hours=9)), ("y", START + timedelta(hours=1))], "k string, start timestamp_ntz")
    missing = ledger.gaps(table, "start", ["k"], F.min("start"), F.max("start"), "1 hour")
    assert sorted((r["k"], r["start"].hour) for r in missing.collect()) == [("x", 1), ("x", 2)]
    assert ledger.refilled(table, source, missing, ["k"], "start").count() == 5
    assert ledger.gaps(table.limit(0), "start", [], F.min("start"), F.max("start"), "1 hour").collect() == []
