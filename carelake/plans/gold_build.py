"""Gold tables built from the test views (used by the query catalogue and bench).

These functions wire the views to the operators; they hold no logic of their
own beyond choosing inputs and the run date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import conditioning as cond
from ..operators import gold
from ..sources import testviews as tv

ADM_AS_OF = tv.ORDERS_AS_OF
LAB_AS_OF = tv.EVENTS_AS_OF


def gold_fact_admissions(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_admissions(tv.admissions(spark, d), ADM_AS_OF)


def gold_dim_ward(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_ward(tv.wards(spark, d), ADM_AS_OF)


def gold_dim_patient(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_patient(tv.patients(spark, d), ADM_AS_OF)


def silver_labs_clean(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_lab_results(tv.lab_results(spark, d), LAB_AS_OF)


def gold_fact_lab_turnaround(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_lab_turnaround(silver_labs_clean(spark, d), LAB_AS_OF)


def gold_fact_pharmacy(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_pharmacy(cond.silver_pharmacy(tv.pharmacy_inventory(spark, d), LAB_AS_OF), LAB_AS_OF)


def gold_fact_icu_alerts(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_icu_alerts(spark, LAB_AS_OF, tv.icu_alerts(spark, d))


# Silver from the faulty bronze views
def silver_patients_dirty(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_patients(tv.bronze_patients(spark, d), ADM_AS_OF)


def silver_admissions_dirty(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_admissions(tv.bronze_admissions(spark, d), ADM_AS_OF)


def silver_discharges_dirty(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_discharges(tv.bronze_discharges(spark, d), ADM_AS_OF)


def silver_wards_dirty(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_wards(tv.bronze_wards(spark, d), ADM_AS_OF)


def silver_labs_dirty(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_lab_results(tv.bronze_lab_results(spark, d), LAB_AS_OF)


def silver_pharmacy_dirty(spark: SparkSession, d: str) -> DataFrame:
    return cond.silver_pharmacy(tv.bronze_pharmacy(spark, d), LAB_AS_OF)
