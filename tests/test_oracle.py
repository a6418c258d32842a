"""Every catalogue query against its DuckDB oracle on the sf0.001 tables."""

import math
import os
from datetime import date, datetime

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from carelake.plans.catalog import all_queries
from carelake.plans.oracle_sql import all_oracles

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


ORACLES = all_oracles()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = all_queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    if name not in ORACLES:
        pytest.skip("no SQL oracle")
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date_key_str", "date_key", "ward_id", "ward_name", "admissions"]
    assert df.count() > 0


def test_partition_count_does_not_change_results(spark):
    q = entry.queries()["agg_04_daily_admissions_by_ward"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(map(tuple, q(spark, SF_SMALL).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = sorted(map(tuple, q(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_counts_by_key_sum_to_total(spark):
    from carelake.sources import testviews as tv

    adm = tv.admissions(spark, SF_SMALL)
    per_day = entry.queries()["agg_03_daily_admissions_summary"](spark, SF_SMALL)
    assert per_day.agg({"daily_admissions": "sum"}).collect()[0][0] == adm.count()
