"""Suite metrics (the metric parts of VS-01, VS-02, VS-06 and VS-08).

Each function returns rows ``(suite, metric, item, value, text)``: scalar
metrics have ``item`` NULL; distributions have one row per value; times are
ISO text in ``text``.  Every metric is an aggregate (distributions grouped,
top-k via per-partition top-k), so output size is bounded by the number of
metrics and distribution values, not by the table size.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ts_lit, whole_days_between
from ..functions.lab_ranges import classify
from ..functions.parse import lenient_double, lenient_timestamp
from ..functions.text import standardise
from ..operators import profile
from .checks import union_all

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def _rows(df: DataFrame, suite: str, metric: str, item: Column | None, value: Column | None, text: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(suite).alias("suite"),
        F.lit(metric).alias("metric"),
        (item if item is not None else F.lit(None)).cast("string").alias("item"),
        (value if value is not None else F.lit(None)).cast("double").alias("value"),
        (text if text is not None else F.lit(None)).cast("string").alias("text"),
    )


def _distribution(df: DataFrame, suite: str, metric: str, col: Column, top: int | None = None) -> DataFrame:
    dist = profile.value_distribution(df.select(col.alias("_v")), "_v")
    if top is not None:
        dist = dist.orderBy(F.desc("count"), F.asc("value")).limit(top)
    return _rows(dist, suite, metric, F.col("value"), F.col("count"))


def patient_metrics(df: DataFrame, as_of: datetime) -> DataFrame:
    """Total patients, gender distribution, average age (days / 365.25, 2 dp)."""
    s = "patients"
    dob = lenient_timestamp("date_of_birth")
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(whole_days_between(dob, as_of)) / F.lit(365.25), 2).alias("age"),
    )
    parts = [_rows(one, s, "total_patients", None, F.col("n")), _rows(one, s, "average_age", None, F.col("age"))]
    if "gender" in df.columns:
        parts.append(_distribution(df, s, "gender_distribution", F.col("gender")))
    return union_all(parts)


def admission_metrics(df: DataFrame) -> DataFrame:
    """Total, latest and earliest admission, ten most frequent wards."""
    s = "admissions"
    t = lenient_timestamp("admission_date")
    one = df.agg(F.count(F.lit(1)).alias("n"), F.max(t).alias("hi"), F.min(t).alias("lo"))
    return union_all([
        _rows(one, s, "total_admissions", None, F.col("n")),
        _rows(one, s, "latest_admission", None, None, F.date_format("hi", ISO)),
        _rows(one, s, "earliest_admission", None, None, F.date_format("lo", ISO)),
        _distribution(df, s, "top_wards", F.col("ward_id"), top=10),
    ])


def pharmacy_metrics(df: DataFrame, as_of: datetime) -> DataFrame:
    """Total drugs, expired drugs, total and mean quantity, categories, five top suppliers."""
    s = "pharmacy"
    q = lenient_double("quantity")
    e = lenient_timestamp("expiry_date")
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(e < ts_lit(as_of)).alias("expired"),
        F.sum(q).alias("total_q"),
        F.avg(q).alias("avg_q"),
    )
    parts = [
        _rows(one, s, "total_drugs", None, F.col("n")),
        _rows(one, s, "expired_drugs", None, F.col("expired")),
        _rows(one, s, "total_quantity", None, F.col("total_q")),
        _rows(one, s, "avg_quantity", None, F.col("avg_q")),
    ]
    if "category" in df.columns:
        parts.append(_distribution(df, s, "drug_categories", F.col("category")))
    if "supplier" in df.columns:
        parts.append(_distribution(df, s, "top_suppliers", F.col("supplier"), top=5))
    return union_all(parts)


def lab_summary(df: DataFrame) -> DataFrame:
    """Lab validation summary: counts, date range, result statistics (exact
    median), tests per day, standardised test-type distribution (top 20) and
    up to ten numeric test types no reference range claims."""
    s = "lab_results"
    t = lenient_timestamp("test_date")
    x = lenient_double("result_value")
    std = standardise("test_type")
    base = df.select("patient_id", "test_type", t.alias("_t"), x.alias("_x"), std.alias("_std"))
    one = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("patient_id").alias("pat"),
        F.countDistinct("test_type").alias("types"),
        F.countDistinct("_std").alias("std_types"),
        F.min("_t").alias("lo"),
        F.max("_t").alias("hi"),
        F.try_divide(F.count("_t").cast("double"), F.countDistinct(F.to_date("_t")).cast("double")).alias("per_day"),
    )
    stats = profile.result_statistics(base, "_x")
    unclassified = profile.distinct_sample(base.filter(F.col("_x").isNotNull() & classify("_std").isNull()), "_std", 10)
    return union_all([
        _rows(one, s, "total_tests", None, F.col("n")),
        _rows(one, s, "unique_patients", None, F.col("pat")),
        _rows(one, s, "unique_test_types", None, F.col("types")),
        _rows(one, s, "unique_standardised_test_types", None, F.col("std_types")),
        _rows(one, s, "date_range_start", None, None, F.date_format("lo", ISO)),
        _rows(one, s, "date_range_end", None, None, F.date_format("hi", ISO)),
        _rows(one, s, "avg_tests_per_day", None, F.col("per_day")),
        *[_rows(stats, s, f"result_{m}", None, F.col(m)) for m in ("mean", "median", "std", "min", "max")],
        _distribution(base, s, "test_type_distribution", F.col("_std"), top=20),
        _rows(unclassified, s, "unclassified_test_types", F.col("value"), None),
    ])
