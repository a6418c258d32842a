"""Further catalogue entries: gold tables, silver conditioning, joins."""

from __future__ import annotations

from ..operators import conditioning as cond
from ..operators import gold
from ..sources import testviews as tv
from . import gold_build as gb
from .catalog import register

# ---------------------------------------------------------------- gold tables


@register("tb_06_dim_patient")
def q_tb_06(spark, d):
    return gb.gold_dim_patient(spark, d)


@register("tb_07_dim_ward")
def q_tb_07(spark, d):
    return gb.gold_dim_ward(spark, d)


@register("tb_08_dim_date")
def q_tb_08(spark, d):
    # The calendar is fixed (2019..2026); the query also tags each day with its
    # lab samples so that it reads, and scales with, the test data.  The
    # calendar is the preserved side; Spark picks the join strategy by size.
    from pyspark.sql import functions as F

    cal = gold.dim_date(spark, gb.LAB_AS_OF)
    labs = gb.silver_labs_clean(spark, d)
    per_day = labs.groupBy(F.to_date("collected_time").alias("full_date")).agg(F.count(F.lit(1)).alias("lab_samples"))
    return cal.join(per_day, "full_date", "left").select(
        *cal.columns, F.coalesce("lab_samples", F.lit(0)).cast("bigint").alias("lab_samples")
    )


@register("tb_09_dim_drug")
def q_tb_09(spark, d):
    return gold.dim_drug(cond.silver_pharmacy(tv.pharmacy_inventory(spark, d), gb.LAB_AS_OF), gb.LAB_AS_OF)


@register("tb_10_fact_admissions")
def q_tb_10(spark, d):
    return gb.gold_fact_admissions(spark, d)


@register("tb_11_fact_labs")
def q_tb_11(spark, d):
    return gold.fact_labs(gb.silver_labs_clean(spark, d), gb.LAB_AS_OF)


@register("tb_12_fact_lab_turnaround")
def q_tb_12(spark, d):
    return gb.gold_fact_lab_turnaround(spark, d)


@register("tb_13_fact_pharmacy")
def q_tb_13(spark, d):
    return gb.gold_fact_pharmacy(spark, d)


@register("tb_14_fact_icu_alerts")
def q_tb_14(spark, d):
    return gb.gold_fact_icu_alerts(spark, d)


# ---------------------------------------------------------------- silver from faulty bronze


@register("tb_01_silver_labs")
def q_tb_01(spark, d):
    return gb.silver_labs_dirty(spark, d)


@register("tb_02_silver_pharmacy")
def q_tb_02(spark, d):
    return gb.silver_pharmacy_dirty(spark, d)


@register("tb_03_silver_patients")
def q_tb_03(spark, d):
    return gb.silver_patients_dirty(spark, d)


@register("tb_04_silver_admissions")
def q_tb_04(spark, d):
    return gb.silver_admissions_dirty(spark, d)


@register("jn_01_patient_admissions")
def q_jn_01(spark, d):
    return cond.patient_admissions(
        gb.silver_admissions_dirty(spark, d),
        gb.silver_discharges_dirty(spark, d),
        gb.silver_wards_dirty(spark, d),
        gb.silver_patients_dirty(spark, d),
        gb.ADM_AS_OF,
    )


from . import catalog_profile  # noqa: E402,F401
from . import catalog_io  # noqa: E402,F401
from . import catalog_doc  # noqa: E402,F401
