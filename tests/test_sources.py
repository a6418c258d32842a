"""Scan-parallelism floor (sources.files.spread_scan)."""

from pyspark.sql import functions as F

from carelake.plans import catalog
from carelake.sources import files
from carelake.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def test_spread_scan_deals_rows_to_all_cores(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert df.rdd.getNumPartitions() == 1
    assert files.spread_scan(df).rdd.getNumPartitions() == cores
    assert files.spread_scan(df, 3).rdd.getNumPartitions() == 3
    assert files.spread_scan(df).count() == df.count()


def test_spread_scan_keeps_filter_pushdown_and_pruning(spark):
    df = files.spread_scan(spark.read.parquet(f"{SF}/events.parquet"))
    plan = df.filter(F.col("event_type") == "error").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" in plan
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_bronze_views_give_the_same_rows_when_spread(spark, monkeypatch):
    q = catalog.all_queries()["vs_08_labs"]
    spread = sorted(map(tuple, q(spark, SF).collect()))
    monkeypatch.setattr(tv, "spread_scan", lambda df: df)
    assert sorted(map(tuple, q(spark, SF).collect())) == spread
