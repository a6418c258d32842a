from collections import Counter
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from carelake.operators import conditioning as cond
from carelake.operators import dedupe, gold, kpi, profile

AS_OF = datetime(2024, 2, 1)


def test_latest_per_key_picks_latest_snapshot_and_keeps_all_rows_without_key(spark):
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01"), (1, "b", "2024-01-02"), (None, "x", "2024-01-01"), (None, "y", "2024-01-01"), (2, "c", "2024-01-01")],
        "k long, v string, dt string",
    )
    out = sorted(((r.k or 0), r.v) for r in dedupe.latest_per_key(df, ["k"], ["dt"]).collect())
    assert out == [(0, "x"), (0, "y"), (1, "b"), (2, "c")]


def test_silver_labs_uses_collected_time_when_no_sample_time(spark):
    df = spark.createDataFrame(
        [("1", "87", "Renal Panel", "164", "2025-11-23T15:03:36.237030", "2025-11-23T20:03:36.237030")],
        "lab_result_id string, patient_id string, test_type string, result_value string, collected_time string, completed_time string",
    )
    r = cond.silver_lab_results(df, AS_OF).collect()[0]
    assert r.turnaround_hours == 5.0
    assert r.test_date == date(2025, 11, 23)
    assert r.patient_id == "87"


def test_silver_pharmacy_backfills_aliases(spark):
    df = spark.createDataFrame([("1", "aspirin", "5", "10", "2024-05-01")], "drug_id string, drug_name string, stock_on_hand string, reorder_level string, expiry_date string")
    r = cond.silver_pharmacy(df, AS_OF).collect()[0]
    assert (r.current_stock, r.threshold, r.expiry_date) == (5, 10, date(2024, 5, 1))


def test_patient_admissions_keeps_left_cardinality(spark):
    adm = spark.createDataFrame([(1, 10, 100, datetime(2024, 1, 1)), (2, 11, 101, datetime(2024, 1, 2))], "admission_id long, patient_id long, ward_id long, admission_time timestamp_ntz")
    # two discharges for admission 1, both carrying patient_id (G7)
    dis = spark.createDataFrame([(7, 1, 10, datetime(2024, 1, 3)), (8, 1, 10, datetime(2024, 1, 4))], "discharge_id long, admission_id long, patient_id long, discharge_time timestamp_ntz")
    wards = spark.createDataFrame([(100, "A")], "ward_id long, ward_name string")
    pats = spark.createDataFrame([(10, "Ann")], "patient_id long, first_name string")
    out = cond.patient_admissions(adm, dis, wards, pats, AS_OF)
    rows = {r.admission_id: r for r in out.collect()}
    assert len(rows) == 2 and out.columns.count("patient_id") == 1
    assert rows[1].discharge_id == 8 and rows[2].discharge_id is None and rows[2].ward_name is None


def test_dim_date_size(spark):
    assert gold.dim_date(spark, AS_OF).count() == 2922


def test_dim_drug_skipped_without_name(spark):
    assert gold.dim_drug(spark.createDataFrame([(1,)], "drug_id long"), AS_OF) is None


def test_icu_alerts_empty_typed(spark):
    df = gold.fact_icu_alerts(spark, AS_OF)
    assert df.count() == 0 and df.schema["alert_time"].dataType.typeName() == "timestamp_ntz"


def test_low_stock_on_empty_input(spark):
    empty = spark.createDataFrame([], "stock_on_hand int, reorder_level int")
    r = kpi.pharmacy_low_stock(empty).collect()[0]
    assert (r.total_items, r.low_stock_items, r.low_stock_pct) == (0, None, None)


def test_low_stock_uses_less_or_equal(spark):
    df = spark.createDataFrame([(5, 5), (6, 5), (1, 5), (None, None)], "current_stock int, threshold int")
    fact = gold.fact_pharmacy(df.withColumn("drug_name", F.lit("d")), AS_OF)
    r = kpi.pharmacy_low_stock(fact).collect()[0]
    # NULL stock -> 0, NULL reorder level -> 10: low
    assert (r.total_items, r.low_stock_items) == (4, 3)


def test_fact_admissions_fills_missing_time_or_not(spark):
    adm = spark.createDataFrame([(1, 2, 3, None)], "admission_id long, patient_id long, ward_id long, admission_time timestamp_ntz")
    assert gold.fact_admissions(adm, AS_OF).collect()[0].admission_time == AS_OF
    assert gold.fact_admissions(adm, AS_OF, fill_missing_times=False).collect()[0].admission_time is None


def test_surplus_and_group_duplicates_with_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert profile.surplus_duplicates(df, "k").collect()[0][0] == 2
    assert profile.duplicate_groups(df, ["k"]).collect()[0][0] == 2
    r = profile.key_uniqueness(df, "k").collect()[0]
    assert (r.total_rows, r.unique_keys, r.keys_unique) == (5, 3, False)


def test_exact_median(spark):
    odd = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 9]], "x double")
    even = spark.createDataFrame([(float(x),) for x in [4, 1, 3, 10]], "x double")
    empty = spark.createDataFrame([], "x double")
    assert profile.exact_median(odd, "x").collect()[0][0] == 3.0
    assert profile.exact_median(even, "x").collect()[0][0] == 3.5
    assert profile.exact_median(empty, "x").collect()[0][0] is None


def test_intervals_cross_buckets_and_midnight(spark):
    rows = [
        (1, datetime(2024, 1, 1, 23, 0)),
        (1, datetime(2024, 1, 2, 1, 0)),   # 2 h later, over midnight: 0 days
        (1, datetime(2024, 1, 2, 1, 0)),   # same time: 0 days
        (1, datetime(2024, 1, 5, 1, 0)),   # 3 days, previous bucket is far back
        (2, datetime(2024, 1, 1, 0, 0)),
        (2, None),
    ]
    df = spark.createDataFrame(rows, "p long, t timestamp_ntz")
    out = profile.test_intervals(df, "p", "t").orderBy("p", "t").collect()
    assert [r.days_since_previous for r in out] == [None, 0, 0, 3, None]
    assert profile.frequent_tests(df, "p", "t").collect()[0][0] == 2


def test_missing_references_null_semantics(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (3,)], "k long")
    dim = spark.createDataFrame([(1,), (None,)], "k long")
    # NULL fact keys are not missing; a NULL in the dimension does not hide misses
    assert sorted(r.k for r in profile.missing_references(fact, dim, "k").collect()) == [2, 3]


def test_rare_values(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "v string")
    # limit = max(1, 5 * 0.5) = 2.5
    assert sorted((r.value, r["count"]) for r in profile.rare_values(df, "v", share=0.5).collect()) == [("b", 1)]


def test_top_k_ties_broken_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert [r.value for r in profile.top_k(df, "v", 2).collect()] == ["c", "a"]


def test_class_statistics_bounds_exclusive(spark):
    df = spark.createDataFrame([("Glucose", 70.0), ("glucose", 140.0), ("GLUCOSE", 141.0), ("glucose", 10.0)], "t string, x double")
    r = profile.class_statistics(df, "t", "x").collect()[0]
    assert (r.range_name, r.below_range, r.above_range, r.total_abnormal, r.severity) == ("glucose", 1, 1, 2, "warning")


def test_intervals_of_one_hot_patient_spread_over_tasks(spark):
    start = datetime(2024, 1, 1)
    rows = [("hot" if i % 2 else f"p{i % 40}", start + timedelta(seconds=(i * 7919) % 3600)) for i in range(4000)]
    df = spark.createDataFrame(rows, "p string, t timestamp_ntz").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = profile.test_intervals(df, "p", "t")
        parts = profile.RangeParts(df, ["p"], ["t"]).rows.filter("p = 'hot'").select("_part").distinct().count()
        found = Counter((r.p, r.t, r.previous_test_time) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, last = Counter(), {}
    for p, t in sorted(rows):
        want[p, t, last.get(p)] += 1
        last[p] = t
    assert found == want and parts >= 2
