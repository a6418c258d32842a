"""Gold KPI views (AGG-04..07, JN-05, SNK-06) in DataFrame form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, date_key_str
from ..functions.numeric import stable


def daily_admissions_by_ward(fact_adm: DataFrame, dim_w: DataFrame) -> DataFrame:
    """AGG-04: admissions per day and ward, with the ward name (JN-05).

    The dimension is joined after the fact is aggregated to (day, ward):
    the join then sees one row per day and ward instead of one per
    admission, and the names are attached to the small side.
    """
    per_day = fact_adm.groupBy(
        date_key("admission_time").alias("date_key"),
        date_key_str("admission_time").alias("date_key_str"),
        "ward_id",
    ).agg(F.count(F.lit(1)).alias("admissions"))
    names = dim_w.select("ward_id", "ward_name")
    joined = per_day.join(names, "ward_id", "left")
    # A ward id that appears twice in the dimension yields one group per name,
    # as grouping by ward_name after the join would.
    return joined.groupBy("date_key_str", "date_key", "ward_id", "ward_name").agg(
        F.sum("admissions").cast("bigint").alias("admissions")
    )


def daily_lab_turnaround(fact_tat: DataFrame) -> DataFrame:
    """AGG-05: tests, mean turnaround and tests over 120 minutes per day."""
    return fact_tat.groupBy(date_key("sample_time").alias("date_key")).agg(
        F.count(F.lit(1)).alias("tests_count"),
        stable(F.avg("turnaround_minutes")).alias("avg_turnaround_minutes"),
        F.sum(F.when(F.col("turnaround_minutes") > 120, 1).otherwise(0)).cast("bigint").alias("delayed_tests_over_120m"),
    )


def pharmacy_low_stock(fact_stock: DataFrame) -> DataFrame:
    """AGG-06: one global row; low stock is ``stock <= reorder level`` (G14)."""
    low = F.sum(F.when(F.col("stock_on_hand") <= F.col("reorder_level"), 1).otherwise(0))
    return fact_stock.agg(
        F.count(F.lit(1)).alias("total_items"),
        low.cast("bigint").alias("low_stock_items"),
        F.try_divide(low.cast("double") * F.lit(100.0), F.count(F.lit(1)).cast("double")).alias("low_stock_pct"),
    )


def daily_icu_alerts(fact_alerts: DataFrame) -> DataFrame:
    """AGG-07."""
    return fact_alerts.groupBy(date_key("alert_time").alias("date_key"), "alert_type", "severity").agg(
        F.count(F.lit(1)).alias("alerts_count")
    )
