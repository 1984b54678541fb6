import math

import duckdb
import pytest

from tidewatt.plans import catalogue, market_queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v.isoformat()[:19] if hasattr(v, "isoformat") else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalogue.SQL:
        assert got
        return
    q = duck.execute(catalogue.SQL[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in q.fetchall())


def test_entry_point(spark, sf):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["event_type", "trade_date", "time_interval", "value_mean", "value_median", "value_last"]
