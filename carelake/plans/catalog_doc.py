"""Catalogue entries of the documented second wave (DOC-01..15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parse import lenient_date, lenient_long
from ..operators import beds
from ..operators import extensions as ext
from ..operators import kpi
from ..sources import testviews as tv
from . import gold_build as gb
from .catalog import register

SALT = "carelake-test-salt"


def _adm_facts(spark, d):
    return ext.admission_facts(tv.admissions(spark, d), tv.discharges(spark, d), gb.ADM_AS_OF)


def _vitals(spark, d):
    return ext.vital_sign_facts(tv.vital_signs(spark, d))


def _lab_facts(spark, d):
    return ext.lab_result_facts(gb.silver_labs_clean(spark, d))


@register("doc_01_calendar")
def q_doc_01(spark, d):
    cal = ext.dim_date_extended(spark, gb.LAB_AS_OF)
    per_day = gb.silver_labs_clean(spark, d).groupBy(F.to_date("collected_time").alias("full_date")).agg(F.count(F.lit(1)).alias("lab_samples"))
    return cal.join(per_day, "full_date", "left").select(*cal.columns, F.coalesce("lab_samples", F.lit(0)).cast("bigint").alias("lab_samples"))


@register("doc_02_dim_time")
def q_doc_02(spark, d):
    t = ext.dim_time(spark)
    per_hour = gb.silver_labs_clean(spark, d).groupBy(F.hour("collected_time").alias("hour")).agg(F.count(F.lit(1)).alias("lab_samples"))
    return t.join(per_hour, "hour", "left").select(*t.columns, F.coalesce("lab_samples", F.lit(0)).cast("bigint").alias("lab_samples"))


@register("doc_03_patient_scd2")
def q_doc_03(spark, d):
    b = tv.bronze_patients(spark, d)
    typed = b.select(
        lenient_long("patient_id").alias("patient_id"), "first_name", "last_name", "gender",
        lenient_date("date_of_birth").alias("date_of_birth"), "dt",
    )
    return ext.patient_versions(typed, "patient_id", ["first_name", "last_name", "gender", "date_of_birth"])


@register("doc_04_ward_utilisation")
def q_doc_04(spark, d):
    return ext.ward_utilisation(tv.wards(spark, d), _adm_facts(spark, d), gb.ADM_AS_OF)


@register("doc_05_vital_signs")
def q_doc_05(spark, d):
    return _vitals(spark, d)


@register("doc_05_icu_alerts_kpi")
def q_doc_05b(spark, d):
    return kpi.daily_icu_alerts(ext.alerts_from_vitals(_vitals(spark, d), gb.LAB_AS_OF))


@register("doc_06_lab_flags")
def q_doc_06(spark, d):
    return _lab_facts(spark, d)


@register("doc_07_pharmacy_flags")
def q_doc_07(spark, d):
    return ext.pharmacy_inventory_facts(tv.pharmacy_inventory(spark, d), gb.LAB_AS_OF)


@register("doc_08_admission_facts")
def q_doc_08(spark, d):
    return _adm_facts(spark, d)


@register("doc_09_bed_occupancy")
def q_doc_09(spark, d):
    # every bed-day row is produced; the result adds them up by ward and day
    return beds.occupancy(beds.bed_days(beds.assign_beds(beds.stays_of(_adm_facts(spark, d), gb.ADM_AS_OF))))


@register("doc_09_bed_stays")
def q_doc_09_stays(spark, d):
    facts = _adm_facts(spark, d)
    given = beds.assign_beds(beds.stays_of(facts, gb.ADM_AS_OF)).select("admission_id", "bed")
    return ext.stay_status(facts).join(given, "admission_id", "left")


@register("doc_10_daily_operations")
def q_doc_10(spark, d):
    af = _adm_facts(spark, d)
    return ext.daily_operations(af, tv.wards(spark, d), gb.ADM_AS_OF)


@register("doc_11_patient_care")
def q_doc_11(spark, d):
    return ext.patient_care_daily(_vitals(spark, d), _lab_facts(spark, d))


@register("doc_12_pharmacy_kpi")
def q_doc_12(spark, d):
    return ext.pharmacy_kpi(ext.pharmacy_inventory_facts(tv.pharmacy_inventory(spark, d), gb.LAB_AS_OF))


@register("doc_13_patient_summary_ext")
def q_doc_13(spark, d):
    dim = ext.dim_patient_standardised(tv.patients(spark, d), gb.ADM_AS_OF)
    return ext.patient_summary_extended(dim, _adm_facts(spark, d), _vitals(spark, d))


@register("doc_14_rules")
def q_doc_14(spark, d):
    dim = ext.dim_patient_standardised(tv.patients(spark, d), gb.ADM_AS_OF)
    return ext.dictionary_rules(_adm_facts(spark, d), tv.pharmacy_inventory(spark, d), _vitals(spark, d), dim)


@register("doc_15_pseudonymised")
def q_doc_15(spark, d):
    return ext.pseudonymise(tv.patients(spark, d), SALT, gb.ADM_AS_OF)
