"""Silver -> gold star schema (TB-06..16, AGG-01..03, JN-04).

Keys are deterministic: the natural id for patient and ward, a SHA-based
surrogate of the natural key elsewhere (G5).  ``created_at`` is the explicit
``as_of``.  Missing admission / lab times fall back to ``as_of`` as in the
reference unless ``fill_missing_times=False`` (G20).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from ..functions.dates import calendar_age, calendar_frame, date_key, elapsed_minutes, iso_day, ts_lit
from ..functions.keys import surrogate_key
from ..functions.parse import col_or_null
from .conditioning import as_long, as_timestamp

ICU_ALERT_SCHEMA = StructType(
    [
        StructField("alert_id", LongType()),
        StructField("patient_id", LongType()),
        StructField("alert_time", TimestampNTZType()),
        StructField("alert_type", StringType()),
        StructField("severity", StringType()),
        StructField("created_at", TimestampNTZType()),
    ]
)


# Columns that tell rows of equal content apart: part of a fact's key where the source has them.
LAB_GRAIN = ["lab_result_id", "source_file"]
STOCK_GRAIN = ["drug_id"]


def _own_ids(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def _fill(c, as_of: datetime, fill: bool):
    return F.coalesce(c, ts_lit(as_of)) if fill else c


# ------------------------------------------------------------------ dimensions

def dim_patient(patients: DataFrame, as_of: datetime) -> DataFrame:
    """TB-06: natural id as key, calendar-year age at ``as_of``."""
    return patients.select(
        F.col("patient_id").alias("patient_key"),
        "patient_id",
        col_or_null(patients, "first_name", "string").alias("first_name"),
        col_or_null(patients, "last_name", "string").alias("last_name"),
        col_or_null(patients, "date_of_birth", "date").alias("birth_date"),
        calendar_age(col_or_null(patients, "date_of_birth", "date"), as_of).alias("age"),
        col_or_null(patients, "gender", "string").alias("gender"),
        ts_lit(as_of).alias("created_at"),
    )


def dim_ward(wards: DataFrame, as_of: datetime) -> DataFrame:
    """TB-07."""
    return wards.select(
        F.col("ward_id").alias("ward_key"),
        "ward_id",
        "ward_name",
        ts_lit(as_of).alias("created_at"),
    )


def dim_date(spark: SparkSession, as_of: datetime, start: str = "2019-01-01", end: str = "2026-12-31") -> DataFrame:
    """TB-08: calendar dimension (SRC-08, FN-01/02)."""
    d = calendar_frame(spark, start, end)
    return d.select(
        date_key("d").alias("date_key"),
        F.col("d").alias("full_date"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        F.dayofmonth("d").alias("day"),
        F.date_format("d", "EEEE").alias("day_name"),
        F.date_format("d", "MMMM").alias("month_name"),
        ts_lit(as_of).alias("created_at"),
    )


def dim_drug(pharmacy: DataFrame, as_of: datetime) -> DataFrame | None:
    """TB-09: one row per drug name; None (skipped) when the column is absent."""
    if "drug_name" not in pharmacy.columns:
        return None
    names = pharmacy.select("drug_name").distinct()
    return names.select(
        surrogate_key("drug_name").alias("drug_key"),
        "drug_name",
        ts_lit(as_of).alias("created_at"),
    )


# ------------------------------------------------------------------ facts

def fact_admissions(admissions: DataFrame, as_of: datetime, fill_missing_times: bool = True) -> DataFrame:
    """TB-10: one row per admission record (silver has one per ``admission_id``)."""
    t = as_timestamp(admissions, "admission_time") if "admission_time" in admissions.columns else F.lit(None).cast("timestamp_ntz")
    rows = admissions.select(
        "admission_id",
        "patient_id",
        "ward_id",
        _fill(t, as_of, fill_missing_times).alias("admission_time"),
    )
    return rows.select(
        surrogate_key("admission_id", "patient_id", "ward_id", "admission_time").alias("admission_key"),
        "admission_id",
        "patient_id",
        "ward_id",
        "admission_time",
        ts_lit(as_of).alias("created_at"),
    )


def fact_labs(labs: DataFrame, as_of: datetime, fill_missing_times: bool = True) -> DataFrame:
    """TB-11: one row per test; tests drawn together differ in their own id."""
    t = as_timestamp(labs, "collected_time") if "collected_time" in labs.columns else F.lit(None).cast("timestamp_ntz")
    ids = _own_ids(labs, LAB_GRAIN)
    rows = labs.select(*ids, as_long(labs, "patient_id").alias("patient_id"), _fill(t, as_of, fill_missing_times).alias("sample_time"))
    return rows.select(
        surrogate_key(*ids, "patient_id", "sample_time").alias("lab_key"),
        "patient_id",
        "sample_time",
        ts_lit(as_of).alias("created_at"),
    )


def fact_lab_turnaround(labs: DataFrame, as_of: datetime, fill_missing_times: bool = True) -> DataFrame:
    """TB-12: one row per test: sample/completed times over their fallback chains and minutes between."""
    def chain(names):
        cols = [as_timestamp(labs, n) for n in names if n in labs.columns]
        return F.coalesce(*cols) if len(cols) > 1 else (cols[0] if cols else F.lit(None).cast("timestamp_ntz"))

    sample = _fill(chain(["sample_datetime", "sample_time", "collected_time"]), as_of, fill_missing_times)
    completed = _fill(chain(["completed_datetime", "completed_time"]), as_of, fill_missing_times)
    ids = _own_ids(labs, LAB_GRAIN)
    rows = labs.select(
        *ids,
        as_long(labs, "patient_id").alias("patient_id"),
        sample.alias("sample_time"),
        completed.alias("completed_time"),
    )
    return rows.select(
        surrogate_key(*ids, "patient_id", "sample_time", "completed_time").alias("lab_turnaround_key"),
        "patient_id",
        "sample_time",
        "completed_time",
        elapsed_minutes("sample_time", "completed_time").alias("turnaround_minutes"),
        ts_lit(as_of).alias("created_at"),
    )


def fact_pharmacy(pharmacy: DataFrame, as_of: datetime) -> DataFrame:
    """TB-13: one row per stock item; stock defaults to 0, reorder level to 10 (PRJ-08)."""
    ids = _own_ids(pharmacy, STOCK_GRAIN)
    rows = pharmacy.select(
        *ids,
        col_or_null(pharmacy, "drug_name", "string").alias("drug_name"),
        F.coalesce(col_or_null(pharmacy, "current_stock", "int"), F.lit(0)).cast("int").alias("stock_on_hand"),
        F.coalesce(col_or_null(pharmacy, "threshold", "int"), F.lit(10)).cast("int").alias("reorder_level"),
    )
    return rows.select(
        surrogate_key(*ids, "drug_name", "stock_on_hand", "reorder_level").alias("inventory_key"),
        "drug_name",
        "stock_on_hand",
        "reorder_level",
        ts_lit(as_of).alias("created_at"),
    )


def fact_icu_alerts(spark: SparkSession, as_of: datetime, alerts: DataFrame | None = None) -> DataFrame:
    """TB-14: typed alert facts; an empty schema-ready table when no source exists."""
    if alerts is None:
        return spark.createDataFrame([], ICU_ALERT_SCHEMA)
    return alerts.select(
        F.col("alert_id").cast("bigint"),
        F.col("patient_id").cast("bigint"),
        as_timestamp(alerts, "alert_time").alias("alert_time"),
        F.col("alert_type").cast("string"),
        F.col("severity").cast("string"),
        ts_lit(as_of).alias("created_at"),
    )


# ------------------------------------------------------------------ summaries

def admissions_per_patient(fact_adm: DataFrame) -> DataFrame:
    """AGG-01 (map-side combined count)."""
    return fact_adm.groupBy("patient_id").agg(F.count(F.lit(1)).alias("admission_count"))


def fallback_admission_counts(dim_pat: DataFrame) -> DataFrame:
    """AGG-02: count 1 per patient when no admission fact exists."""
    return dim_pat.select("patient_id", F.lit(1).cast("bigint").alias("admission_count"))


def patient_summary(dim_pat: DataFrame, counts: DataFrame, as_of: datetime) -> DataFrame:
    """TB-15 / JN-04: dimension ⟕ aggregated counts, missing → 0."""
    return dim_pat.join(counts, "patient_id", "left").select(
        "patient_key",
        "patient_id",
        "first_name",
        "last_name",
        "age",
        "gender",
        F.coalesce(F.col("admission_count"), F.lit(0)).cast("bigint").alias("total_admissions"),
        ts_lit(as_of).alias("created_at"),
    )


def daily_admissions_summary(fact_adm: DataFrame) -> DataFrame:
    """TB-16 / AGG-03: per day count and distinct patients / wards, by date."""
    return (
        fact_adm.groupBy(iso_day("admission_time").alias("admission_date"))
        .agg(
            F.count(F.lit(1)).alias("daily_admissions"),
            F.countDistinct("patient_id").alias("unique_patients"),
            F.countDistinct("ward_id").alias("active_wards"),
        )
        .orderBy("admission_date")
    )
