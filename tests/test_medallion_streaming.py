from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF_SMALL

from carelake.operators import kpi
from carelake.plans import gold_build as gb
from carelake.plans.medallion import Lake, run, validate_layers
from carelake.session import scratch_path
from carelake.sources import testviews as tv
from carelake.streaming.incremental import ingest_labs_to_silver, run_daily_turnaround

AS_OF = datetime(2024, 2, 1)


def test_medallion_end_to_end(spark):
    lake = Lake(scratch_path(spark, "lake-test"))
    status = {r.table: r for r in run(spark, SF_SMALL, lake, "20240201T000000Z", AS_OF).collect()}
    assert all(r.status == "ok" for r in status.values()), [r for r in status.values() if r.status != "ok"]
    assert status["dim_date"].rows == 2922 and status["fact_icu_alerts"].rows == 0
    assert status["fact_pharmacy_stock"].rows == status["fact_pharmacy"].rows
    roll = validate_layers(spark, lake, AS_OF, "2024-02-01").collect()[0]
    assert roll.tables_checked == 9
    # dirty inputs: NULL keys and future dates make some suites fail
    assert roll.all_passed is False and "patients" in roll.failed_tables
    written = spark.read.json(f"{lake.root}/gold/validation/2024-02-01/dim_patient_validation").collect()
    assert written[0].table_name == "dim_patient"


def test_streaming_daily_turnaround_matches_batch_for_closed_days(spark):
    root = scratch_path(spark, "stream-kpi-test")
    raw = tv.bronze_lab_results(spark, SF_SMALL)
    raw.write.parquet(f"{root}/landing/2024/01/31")
    ingest_labs_to_silver(spark, f"{root}/landing/*/*/*", raw.schema, f"{root}/silver", f"{root}/_ck1", AS_OF).awaitTermination()
    silver_stream = spark.readStream.schema(spark.read.parquet(f"{root}/silver").schema).parquet(f"{root}/silver")
    run_daily_turnaround(silver_stream, f"{root}/kpi", f"{root}/_ck2").awaitTermination()
    streamed = {r.date_key: r for r in spark.read.parquet(f"{root}/kpi").collect()}
    batch_in = gb.gold_fact_lab_turnaround(spark, SF_SMALL)
    batch = {r.date_key: r for r in kpi.daily_lab_turnaround(batch_in).collect()}
    assert streamed, "closed days must be emitted"
    for k, r in streamed.items():
        assert r.tests_count == batch[k].tests_count
        assert r.delayed_tests_over_120m == batch[k].delayed_tests_over_120m
