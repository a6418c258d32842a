"""Hospital views over the driver's TPC-H-like test tables.

Each view is a thin projection of one or two test tables (see SURVEY §7.1),
written once here and once as SQL in ``carelake.plans.oracle_sql``.  Views
whose name starts with ``bronze_`` are raw text tables with faults injected
by key arithmetic, because the test tables themselves contain no NULL,
duplicate or malformed value.  All views read the whole tables, so their work
grows with the scale factor.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import spread_scan

# Fixed run dates of the test views.
ORDERS_AS_OF = datetime(2001, 8, 1)
EVENTS_AS_OF = datetime(2024, 2, 1)

# Fixed mapping values (test-view design, mirrored in the oracle SQL).
GENDER_BY_SEGMENT = [
    ("HOUSEHOLD", "F"),
    ("FURNITURE", "F"),
    ("MACHINERY", "M"),
    ("BUILDING", "M"),
    ("AUTOMOBILE", "O"),
]
TEST_TYPE_BY_EVENT = [
    ("click", "Glucose"),
    ("view", "Hemoglobin"),
    ("purchase", "Sodium"),
    ("error", "ALT"),
    ("signup", "Renal Panel"),
]
STATUS_BY_ORDER_STATUS = [("O", "Active"), ("F", "Discharged"), ("P", "Transferred")]
ALERT_TYPES = ["HEART_RATE", "SPO2", "BLOOD_PRESSURE"]


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One test table.  ``spread`` (used by the bronze views, whose per-row
    text work is heavy) deals its rows out to all cores: each test table is
    one file with one row group, read by a single task.  Views that aggregate
    right after the scan read it as is, since there a spread costs more than
    it saves."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_scan(df) if spread else df


def _case(col: Column, pairs) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr


def _mod(c: str, m: int) -> Column:
    return F.pmod(F.col(c), F.lit(m))


# ---------------------------------------------------------------- clean views

def wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # region has a fixed handful of rows: broadcasting it is size-safe.
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("bigint").alias("ward_id"),
        F.col("n_name").alias("ward_name"),
        F.col("r_name").alias("ward_type"),
        (F.pmod(F.col("n_nationkey") * 53, F.lit(240)) - 20).cast("int").alias("capacity"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("patient_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.date_add(F.lit("1930-01-01").cast("date"), F.pmod(F.col("c_custkey") * 37, F.lit(36500)).cast("int")).alias("date_of_birth"),
        _case(F.col("c_mktsegment"), GENDER_BY_SEGMENT).alias("gender"),
    )


def admissions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders", spread)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("o_orderkey").alias("admission_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("c_nationkey").cast("bigint").alias("ward_id"),
        F.col("o_orderdate").alias("admission_time"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("triage_level"),
        _case(F.col("o_orderstatus"), STATUS_BY_ORDER_STATUS).alias("status"),
    )


def discharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("discharge_time"))
    return last_ship.join(o, last_ship.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_orderkey").alias("discharge_id"),
        F.col("o_orderkey").alias("admission_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("discharge_time"),
    )


def lab_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("lab_result_id"),
        F.col("user_id").alias("patient_id"),
        _case(F.col("event_type"), TEST_TYPE_BY_EVENT).alias("test_type"),
        F.col("value").alias("result_value"),
        F.lit("mg/dL").alias("unit"),
        F.col("ts").alias("collected_time"),
        F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts")).alias("completed_time"),
    )


def pharmacy_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("drug_id"),
        F.col("p_name").alias("drug_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("supplier"),
        F.col("p_size").alias("current_stock"),
        F.pmod(F.col("p_partkey"), F.lit(20)).cast("int").alias("threshold"),
        F.col("p_retailprice").alias("unit_price"),
        F.date_add(F.lit("2024-02-01").cast("date"), (F.pmod(F.col("p_partkey"), F.lit(800)) - 100).cast("int")).alias("expiry_date"),
    )


def icu_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    k = F.get_json_object("props", "$.k").cast("int")
    alert_type = F.element_at(F.array(*[F.lit(a) for a in ALERT_TYPES]), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    return e.select(
        F.col("event_id").alias("alert_id"),
        F.col("user_id").alias("patient_id"),
        F.col("ts").alias("alert_time"),
        alert_type.alias("alert_type"),
        F.when(F.col("value") >= 300, "CRITICAL").when(F.col("value") >= 100, "HIGH").otherwise("MEDIUM").alias("severity"),
    )


# ---------------------------------------------------------------- bronze (raw text with faults)

def _iso_ts(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def bronze_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots (``dt``) of raw patient rows; the later one changes every 50th."""
    c = table(spark, sf_dir, "customer", spread=True)
    key = F.col("c_custkey")
    dob = F.date_add(F.lit("1930-01-01").cast("date"), F.pmod(key * 37, F.lit(36500)).cast("int"))
    base = c.select(
        F.when(_mod("c_custkey", 101) == 7, F.lit(None)).otherwise(key.cast("string")).alias("patient_id"),
        F.when(_mod("c_custkey", 97) == 5, F.lit(" ")).otherwise(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
        F.when(_mod("c_custkey", 89) == 3, F.lit(None)).otherwise(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("last_name"),
        F.when(_mod("c_custkey", 83) == 2, F.lit("not-a-date"))
        .when(_mod("c_custkey", 113) == 5, F.date_format(dob, "yyyy/MM/dd"))
        .when(_mod("c_custkey", 131) == 7, F.date_format(dob, "yyyyMMdd"))
        .otherwise(F.date_format(dob, "yyyy-MM-dd")).alias("date_of_birth"),
        _case(F.col("c_mktsegment"), GENDER_BY_SEGMENT).alias("gender"),
        F.lit("2001-07-01").alias("dt"),
        key.alias("_k"),
    )
    later = base.filter(_mod("_k", 50) == 0).withColumn("last_name", F.concat(F.coalesce(F.col("last_name"), F.lit("")), F.lit("-v2"))).withColumn("dt", F.lit("2001-08-01"))
    return base.unionByName(later).drop("_k")


def bronze_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = admissions(spark, sf_dir, spread=True)
    raw = a.select(
        F.when(_mod("admission_id", 107) == 9, F.lit(None)).otherwise(F.col("admission_id").cast("string")).alias("admission_id"),
        F.when(_mod("admission_id", 101) == 1, F.lit(None)).otherwise(F.col("patient_id").cast("string")).alias("patient_id"),
        F.when(_mod("admission_id", 83) == 4, F.lit("n/a"))
        .when(_mod("admission_id", 113) == 5, F.date_format("admission_time", "yyyy/MM/dd HH:mm:ss"))
        .when(_mod("admission_id", 127) == 6, F.date_format("admission_time", "dd MMM yyyy"))
        .otherwise(_iso_ts(F.col("admission_time"))).alias("admission_date"),
        F.col("ward_id").cast("string").alias("ward_id"),
        F.lit("2001-08-01").alias("dt"),
        F.col("admission_id").alias("_k"),
    )
    dup = raw.filter(_mod("_k", 50) == 0)
    return raw.unionByName(dup).drop("_k")


def bronze_lab_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", spread=True)
    k = "event_id"
    test_type = _case(F.col("event_type"), TEST_TYPE_BY_EVENT)
    return e.select(
        F.when(_mod(k, 103) == 7, (F.col(k) + F.lit(9007199254740993)).cast("string"))
        .when(_mod(k, 109) == 8, F.concat(F.col(k).cast("string"), F.lit(".0")))
        .otherwise(F.col(k).cast("string")).alias("lab_result_id"),
        F.when(_mod(k, 101) == 3, F.lit(None))
        .when(_mod(k, 97) == 1, F.concat(F.lit("P#"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string")).alias("patient_id"),
        F.when(_mod(k, 89) == 2, F.lit(None)).when(_mod(k, 83) == 5, F.lit("  ")).otherwise(test_type).alias("test_type"),
        F.when(_mod(k, 79) == 4, F.lit("tbd"))
        .when(_mod(k, 71) == 1, F.lit("2024-02-05 10:00:00"))
        .when(_mod(k, 67) == 2, F.lit("2024-03-15 10:00:00"))
        .when(_mod(k, 113) == 5, F.date_format("ts", "yyyy/MM/dd"))
        .when(_mod(k, 127) == 6, F.date_format("ts", "dd MMM yyyy"))
        .when(_mod(k, 131) == 7, F.date_format("ts", "yyyyMMdd"))
        .otherwise(_iso_ts(F.col("ts"))).alias("test_date"),
        F.when(_mod(k, 61) == 3, F.lit("positive"))
        .when(_mod(k, 59) == 4, F.lit(None))
        .when((_mod(k, 53) == 5) & (F.col("event_type") == "click"), F.concat(F.lit("-"), F.col("value").cast("string")))
        .otherwise(F.col("value").cast("string")).alias("result_value"),
        _iso_ts(F.col("ts")).alias("collected_time"),
        _iso_ts(F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts"))).alias("completed_time"),
    )


def bronze_pharmacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", spread=True)
    k = "p_partkey"
    expiry = F.date_add(F.lit("2024-02-01").cast("date"), (F.pmod(F.col(k), F.lit(800)) - 100).cast("int"))
    raw = p.select(
        F.when(_mod(k, 109) == 8, F.concat(F.lit(" D-"), F.col(k).cast("string"))).otherwise(F.col(k).cast("string")).alias("drug_id"),
        F.when(_mod(k, 101) == 1, F.lit(None))
        .when(_mod(k, 97) == 2, F.lit(""))
        .when(_mod(k, 89) == 3, F.lit("X"))
        .when(_mod(k, 83) == 4, F.lit("12345"))
        .otherwise(F.col("p_name")).alias("drug_name"),
        F.when(_mod(k, 79) == 5, F.lit("n/a"))
        .when(_mod(k, 73) == 6, F.lit("-1"))
        .when(_mod(k, 71) == 0, F.lit("0"))
        .when(_mod(k, 67) == 1, F.lit("1500"))
        .when(_mod(k, 61) == 2, F.lit("20000"))
        .otherwise(F.col("p_size").cast("string")).alias("quantity"),
        F.when(_mod(k, 59) == 3, F.lit("bad"))
        .when(_mod(k, 53) == 4, F.lit("1999-05-01"))
        .when(_mod(k, 47) == 5, F.lit("2031-01-01"))
        .when(_mod(k, 113) == 5, F.date_format(expiry, "dd MMM yyyy"))
        .otherwise(F.date_format(expiry, "yyyy-MM-dd")).alias("expiry_date"),
        F.when(_mod(k, 43) == 6, F.lit(None)).when(_mod(k, 41) == 0, F.lit("antibiotic")).otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("supplier"),
        F.col("p_size").cast("string").alias("stock_on_hand"),
        F.pmod(F.col(k), F.lit(20)).cast("string").alias("reorder_level"),
        F.col(k).alias("_k"),
    )
    dup = raw.filter(_mod("_k", 50) == 0)
    return raw.unionByName(dup).drop("_k")


def bronze_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wards(spark, sf_dir)
    return w.select(
        F.col("ward_id").cast("string").alias("ward_id"),
        F.col("ward_name"),
        F.col("capacity").cast("string").alias("capacity"),
        F.lit("2001-08-01").alias("dt"),
    )


def bronze_discharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = discharges(spark, sf_dir)
    return d.select(
        F.col("discharge_id").cast("string").alias("discharge_id"),
        F.col("admission_id").cast("string").alias("admission_id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        F.when(_mod("discharge_id", 97) == 3, F.lit("??")).otherwise(_iso_ts(F.col("discharge_time"))).alias("discharge_date"),
        F.lit("2001-08-01").alias("dt"),
    )


def vital_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vital-sign readings derived from events (one reading per event); some readings are missing."""
    e = table(spark, sf_dir, "events")
    k = "event_id"

    def there(c: Column, *gaps: tuple[int, int]) -> Column:
        lost = F.lit(False)
        for n, r in (*gaps, (211, 9)):
            lost = lost | (_mod(k, n) == r)
        return F.when(~lost, c)

    return e.select(
        F.col(k).alias("reading_id"),
        F.col("user_id").alias("patient_id"),
        F.col("ts").alias("measurement_time"),
        there((F.lit(35) + F.pmod(F.floor(F.col("value") * 7), F.lit(110))).cast("int")).alias("heart_rate"),
        there((F.lit(85) + F.pmod(F.floor(F.col("value")), F.lit(140))).cast("int"), (37, 5)).alias("blood_pressure_systolic"),
        (F.lit(45) + _mod(k, 60)).cast("int").alias("blood_pressure_diastolic"),
        there(F.lit(35.0) + _mod(k, 60).cast("double") / F.lit(10.0)).alias("temperature"),
        there((F.lit(88) + _mod(k, 13)).cast("int")).alias("oxygen_saturation"),
        there((F.lit(8) + _mod(k, 23)).cast("int"), (31, 4)).alias("respiratory_rate"),
    )
