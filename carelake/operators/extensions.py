"""Documented-only operators (DOC-01..15): calendar/time dimensions, patient
versions, ward utilisation, vital signs with early-warning scores, extended
facts, bed occupancy, daily KPIs and the rule checks of the data dictionary.

Choices the documents leave open are marked ◇ in the docstrings.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import calendar_age, date_key, elapsed_hours, elapsed_minutes, ts_lit
from ..functions.keys import surrogate_key
from ..functions.lab_ranges import classify
from ..functions.numeric import stable
from ..quality.checks import ISSUE, RowCheck, run_row_checks, union_all
from .dedupe import latest_per_key
from .gold import dim_date


# ------------------------------------------------------------------ DOC-01 / DOC-02

def dim_date_extended(spark: SparkSession, as_of: datetime, start: str = "2019-01-01", end: str = "2026-12-31") -> DataFrame:
    """DOC-01: calendar with quarter, weekday (1 = Sunday), ISO week, month end."""
    d = dim_date(spark, as_of, start, end)
    dow = F.dayofweek("full_date")
    return d.select(
        "*",
        F.quarter("full_date").alias("quarter"),
        dow.alias("day_of_week"),
        F.dayofyear("full_date").alias("day_of_year"),
        F.weekofyear("full_date").alias("week_of_year"),
        F.when(dow.isin(1, 7), "Weekend").otherwise("Weekday").alias("day_type"),
        F.last_day("full_date").alias("month_end_date"),
        F.datediff(F.last_day("full_date"), F.col("full_date")).alias("days_until_month_end"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """DOC-02: 24 hours.  ◇ periods: Night 0-5, Morning 6-11, Afternoon 12-17,
    Evening 18-23; ◇ business hours 09:00-16:59."""
    h = F.col("id").cast("int")
    return spark.range(24).select(
        h.alias("time_key"),
        h.alias("hour"),
        F.format_string("%02d:00", h).alias("hour_display"),
        F.when(h < 6, "Night").when(h < 12, "Morning").when(h < 18, "Afternoon").otherwise("Evening").alias("time_of_day"),
        F.when((h >= 9) & (h < 17), "Business Hours").otherwise("Non-Business Hours").alias("business_hours_flag"),
    )


# ------------------------------------------------------------------ DOC-03 / DOC-15

def standardise_gender(c: Column | str) -> Column:
    v = F.upper(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.when(v.isin("M", "MALE"), "M").when(v.isin("F", "FEMALE"), "F").otherwise("O")


def clean_phone(c: Column | str) -> Column:
    """◇ digits and a leading '+' only."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[^0-9+]", "")


def dim_patient_standardised(patients: DataFrame, as_of: datetime) -> DataFrame:
    """DOC-03: standard gender, age validity."""
    age = calendar_age("date_of_birth", as_of)
    return patients.select(
        F.col("patient_id").alias("patient_key"),
        "patient_id",
        "first_name",
        "last_name",
        F.col("date_of_birth").alias("birth_date"),
        age.alias("age"),
        standardise_gender("gender").alias("gender_standardized"),
        ((age >= 0) & (age <= 120)).alias("age_valid"),
    )


def patient_versions(snapshots: DataFrame, key: str, attrs: list[str], dt: str = "dt") -> DataFrame:
    """DOC-03 SCD2: one row per change of ``attrs`` across snapshots.

    Rows are reduced to one per (key, snapshot) first; versions start where the
    attribute hash differs from the previous snapshot's.  Windows are
    partitioned by key and hold that key's snapshots only.
    """
    per_snap = latest_per_key(snapshots.select(key, dt, *attrs), [key, dt], [])
    w = Window.partitionBy(key).orderBy(dt)
    h = F.sha2(F.to_json(F.struct(*attrs)), 256)
    marked = per_snap.filter(F.col(key).isNotNull()).withColumn("_h", h).withColumn("_prev", F.lag("_h").over(w))
    versions = marked.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("_h")))
    versions = versions.withColumn("valid_to", F.lead(dt).over(w))
    return versions.select(
        key,
        *attrs,
        F.col(dt).alias("valid_from"),
        "valid_to",
        F.when(F.col("valid_to").isNull(), 1).otherwise(0).alias("current_row_flag"),
    )


def pseudonymise(patients: DataFrame, salt: str, as_of: datetime) -> DataFrame:
    """DOC-15: salted SHA-256 token instead of id; names and contact dropped."""
    return patients.select(
        F.sha2(F.concat(F.lit(salt), F.col("patient_id").cast("string")), 256).alias("patient_token"),
        F.year("date_of_birth").alias("birth_year"),
        calendar_age("date_of_birth", as_of).alias("age"),
        standardise_gender("gender").alias("gender_standardized"),
    )


# ------------------------------------------------------------------ DOC-08 / DOC-04 / DOC-09

def admission_facts(admissions: DataFrame, discharges: DataFrame, as_of: datetime) -> DataFrame:
    """DOC-08: admissions with date/time keys, discharge, occupancy hours, status.

    Occupancy runs to the discharge or, for open stays, to ``as_of``; it is
    never negative (a discharge before the admission gives 0).
    """
    dis = latest_per_key(discharges.select("admission_id", "discharge_time"), ["admission_id"], ["discharge_time"])
    a = admissions.join(dis, "admission_id", "left")
    end = F.coalesce(F.col("discharge_time"), ts_lit(as_of))
    return a.select(
        surrogate_key("admission_id").alias("admission_key"),
        "admission_id",
        "patient_id",
        "ward_id",
        F.col("admission_time").alias("admission_timestamp"),
        date_key("admission_time").alias("admission_date_key"),
        F.hour("admission_time").alias("admission_time_key"),
        "triage_level",
        F.when(F.col("discharge_time").isNotNull(), "Discharged").otherwise(F.coalesce(F.col("status"), F.lit("Active"))).alias("admission_status"),
        F.col("discharge_time").alias("discharge_timestamp"),
        F.greatest(F.lit(0.0), elapsed_hours("admission_time", end)).alias("occupancy_hours"),
        F.col("discharge_time").isNotNull().cast("int").alias("is_discharged"),
    )


def ward_utilisation(wards: DataFrame, adm_facts: DataFrame, as_of: datetime) -> DataFrame:
    """DOC-04: occupied beds at ``as_of``, utilisation, ◇ category by ward type."""
    now = ts_lit(as_of)
    active = adm_facts.filter(
        (F.col("admission_timestamp") <= now) & (F.col("discharge_timestamp").isNull() | (F.col("discharge_timestamp") > now))
    )
    occ = active.groupBy("ward_id").agg(F.count(F.lit(1)).alias("beds_occupied"))
    w = wards.join(occ, "ward_id", "left")
    occupied = F.coalesce(F.col("beds_occupied"), F.lit(0)).cast("bigint")
    wt = F.upper(F.coalesce(F.col("ward_type"), F.lit("")))
    return w.select(
        F.col("ward_id").alias("ward_key"),
        "ward_id",
        "ward_name",
        "ward_type",
        F.when(wt.isin("ICU", "EMERGENCY"), "Critical").when(wt.isin("PEDIATRIC", "MATERNITY", "SURGICAL"), "Specialized").otherwise("General").alias("ward_category"),
        F.col("capacity").alias("total_beds"),
        occupied.alias("beds_occupied"),
        F.greatest(F.col("capacity") - occupied, F.lit(0)).alias("available_beds"),
        F.round(F.try_divide(occupied.cast("double") * 100.0, F.col("capacity").cast("double")), 2).alias("utilization_rate"),
    )


def stay_status(adm_facts: DataFrame) -> DataFrame:
    """Which stays the bed-day fact (:mod:`.beds`) holds: ``closed`` and, up to its run date, ``open`` ones;
    ``invalid`` ones (no admission time, or a discharge before it) have no days."""
    s, e = F.col("admission_timestamp"), F.col("discharge_timestamp")
    status = F.when(s.isNull() | (e < s), "invalid").when(e.isNull(), "open").otherwise("closed")
    return adm_facts.select("admission_id", "ward_id", status.alias("stay_status"))


def daily_operations(adm_facts: DataFrame, wards: DataFrame, as_of: datetime) -> DataFrame:
    """DOC-10: per (day, ward) admissions, discharges, occupied beds and hours.

    A stay runs to its discharge or, while open, to ``as_of``.  It is not
    expanded into its days: it gives at most five narrow rows of changes (bed
    taken, bed free again, first and last whole day, discharge), which one
    aggregate by (day, ward) adds up before a running sum over the days of each
    ward; days without a change repeat the day before.  Stays whose end lies
    before their begin count as admission and discharge and occupy no bed.  A
    missing ward is a ward of its own.
    """
    s, e = F.col("admission_timestamp"), F.coalesce(F.col("discharge_timestamp"), ts_lit(as_of))
    d0, d1 = F.to_date(s), F.to_date(e)
    stays = s.isNotNull() & (e >= s)
    several = stays & (d1 > d0)

    def change(day: Column, only: Column, **what) -> Column:
        names = ("adm", "dis", "bed", "whole", "hours")
        row = [F.coalesce(what[n], F.lit(0.0)).alias(n) if n == "hours" and n in what else F.lit(what.get(n, 0.0 if n == "hours" else 0)).alias(n) for n in names]
        return F.when(only & day.isNotNull(), F.struct(day.alias("day"), *row))

    first = F.when(several, elapsed_hours("_s", F.date_add(d0, 1).cast("timestamp_ntz"))).otherwise(elapsed_hours("_s", "_e"))
    last = elapsed_hours(d1.cast("timestamp_ntz"), "_e")
    rows = adm_facts.select("ward_id", "admission_timestamp", "discharge_timestamp", s.alias("_s"), e.alias("_e")).select(
        "ward_id",
        F.explode(F.array_compact(F.array(
            change(d0, F.lit(True), adm=1),
            change(d0, stays, bed=1, hours=first),
            change(F.date_add(d1, 1), stays, bed=-1),
            change(F.date_add(d0, 1), several, whole=1),
            change(d1, several, whole=-1, hours=last),
            change(F.to_date("discharge_timestamp"), F.col("discharge_timestamp").isNotNull(), dis=1),
        ))).alias("c"),
    )
    daily = rows.groupBy("ward_id", "c.day").agg(*[F.sum(f"c.{n}").alias(n) for n in ("adm", "dis", "bed", "whole", "hours")])
    days = Window.partitionBy("ward_id").orderBy("day")
    daily = daily.select(
        "ward_id", "day", "adm", "dis", "hours",
        F.sum("bed").over(days).alias("beds"), F.sum("whole").over(days).alias("whole"), F.lead("day").over(days).alias("next"),
    )
    upto = F.when(F.col("next").isNotNull() & (F.col("beds") > 0), F.date_sub("next", 1)).otherwise(F.col("day"))
    each = daily.select("*", F.explode(F.sequence("day", upto)).alias("_day"))
    own = F.col("_day") == F.col("day")  # the day of the change; the days after it repeat its beds
    each = each.select(
        "ward_id",
        date_key("_day").alias("date_key"),
        F.when(own, F.col("adm")).otherwise(0).cast("bigint").alias("admission_count"),
        F.when(own, F.col("dis")).otherwise(0).cast("bigint").alias("discharge_count"),
        F.col("beds").cast("bigint").alias("occupied_beds"),
        (F.col("whole") * 24.0 + F.when(own, F.col("hours")).otherwise(0.0)).alias("total_occupancy_hours"),
    ).filter("admission_count > 0 OR discharge_count > 0 OR occupied_beds > 0")
    j = each.join(wards.select("ward_id", "ward_name", "ward_type", F.col("capacity").alias("total_beds")), "ward_id", "left")
    return j.select(
        "date_key",
        "ward_id",
        "ward_name",
        "ward_type",
        "total_beds",
        "admission_count",
        "discharge_count",
        "occupied_beds",
        stable(F.col("total_occupancy_hours")).alias("total_occupancy_hours"),
        F.round(F.try_divide(F.col("occupied_beds").cast("double") * 100.0, F.col("total_beds").cast("double")), 2).alias("occupancy_rate"),
    )


# ------------------------------------------------------------------ DOC-05 vital signs

def _band(x: Column, edges: list[tuple[float, int]], top: int) -> Column:
    """Score of the first ``x <= edge`` band, ``top`` above the last edge; a missing reading has no score."""
    expr = None
    for edge, score in edges:
        expr = F.when(x <= edge, score) if expr is None else expr.when(x <= edge, score)
    return expr.when(x.isNotNull(), top)


# Published NEWS2 bands (scale 1 for SpO2), as (upper edge, score).
NEWS2_RESP = ([(8, 3), (11, 1), (20, 0), (24, 2)], 3)
NEWS2_SPO2 = ([(91, 3), (93, 2), (95, 1)], 0)
NEWS2_SYSTOLIC = ([(90, 3), (100, 2), (110, 1), (219, 0)], 3)
NEWS2_PULSE = ([(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)], 3)
NEWS2_TEMP = ([(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)], 2)


def vital_sign_facts(vitals: DataFrame) -> DataFrame:
    """DOC-05: range flags, NEWS2 early-warning score, ◇ critical flag
    (score >= 7 or any single parameter scoring 3), blood-pressure category.
    A missing reading scores nothing and is counted in ``missing_readings``;
    values are in range only if all readings are there."""
    comps = {
        "resp_score": _band(F.col("respiratory_rate"), *NEWS2_RESP),
        "spo2_score": _band(F.col("oxygen_saturation"), *NEWS2_SPO2),
        "systolic_score": _band(F.col("blood_pressure_systolic"), *NEWS2_SYSTOLIC),
        "pulse_score": _band(F.col("heart_rate"), *NEWS2_PULSE),
        "temp_score": _band(F.col("temperature"), *NEWS2_TEMP),
    }
    v = vitals.select("*", *[c.alias(n) for n, c in comps.items()])
    missing = sum((F.col(n).isNull().cast("int") for n in comps), F.lit(0))
    # the score of the readings that are there; none at all has no score and raises no alert
    ews = F.when(missing < len(comps), sum((F.coalesce(F.col(n), F.lit(0)) for n in comps), F.lit(0)))
    any3 = F.greatest(*[F.col(n) for n in comps]) >= 3
    s, d = F.col("blood_pressure_systolic"), F.col("blood_pressure_diastolic")
    bp = (
        F.when(s.isNull() | d.isNull(), "Unknown")
        .when((s >= 140) | (d >= 90), "Stage 2 Hypertension")
        .when((s >= 130) | (d >= 80), "Stage 1 Hypertension")
        .when(s >= 120, "Elevated")
        .otherwise("Normal")
    )
    valid = (
        F.col("heart_rate").between(30, 250)
        & F.col("oxygen_saturation").between(70, 100)
        & F.col("temperature").between(30, 45)
        & s.between(70, 250)
        & d.between(40, 150)
        & F.col("respiratory_rate").between(5, 60)
        & (s > d)
    )
    return v.select(
        surrogate_key("reading_id").alias("vital_key"),
        "reading_id",
        "patient_id",
        F.col("measurement_time").alias("measurement_timestamp"),
        date_key("measurement_time").alias("measurement_date_key"),
        F.hour("measurement_time").alias("measurement_time_key"),
        "heart_rate",
        "blood_pressure_systolic",
        "blood_pressure_diastolic",
        "temperature",
        "oxygen_saturation",
        "respiratory_rate",
        ews.alias("ews_score"),
        missing.alias("missing_readings"),
        F.coalesce((ews >= 7) | any3, F.lit(False)).alias("is_critical"),
        bp.alias("bp_category"),
        F.coalesce(valid, F.lit(False)).alias("in_valid_range"),
    )


def alerts_from_vitals(vital_facts: DataFrame, as_of: datetime) -> DataFrame:
    """DOC-05: ICU alert rows from critical readings (fills TB-14)."""
    crit = vital_facts.filter(F.col("is_critical"))
    return crit.select(
        F.col("reading_id").alias("alert_id"),
        "patient_id",
        F.col("measurement_timestamp").alias("alert_time"),
        F.lit("CRITICAL_VITALS").alias("alert_type"),
        F.when(F.col("ews_score") >= 7, "HIGH").otherwise("MEDIUM").alias("severity"),
        ts_lit(as_of).alias("created_at"),
    )


# ------------------------------------------------------------------ DOC-06 / DOC-07

def lab_result_facts(labs: DataFrame) -> DataFrame:
    """DOC-06: delay flag (> 2 h), SLA (< 4 h), status, ◇ test category."""
    name = F.lower(F.coalesce(F.col("test_type"), F.lit("")))
    category = (
        F.when(name.contains("urine"), "Urine Test")
        .when(name.rlike("x-ray|xray|mri|scan|imaging|ultrasound"), "Imaging")
        .when(classify("test_type").isNotNull() | name.rlike("blood|panel|count|function"), "Blood Test")
        .otherwise("Other Test")
    )
    tat = elapsed_minutes("sample_datetime", "completed_datetime")
    done = F.col("completed_datetime").isNotNull()
    return labs.select(
        surrogate_key("lab_result_id").alias("lab_result_key"),
        "lab_result_id",
        "patient_id",
        F.col("sample_datetime").alias("sample_timestamp"),
        date_key("sample_datetime").alias("sample_date_key"),
        F.col("completed_datetime").alias("completion_timestamp"),
        F.col("test_type").alias("test_name"),
        category.alias("test_category"),
        F.col("result_value").cast("string").alias("result"),
        tat.alias("turnaround_minutes"),
        (tat > 120).alias("is_delayed"),
        (tat < 240).alias("meets_sla"),
        F.when(done, "Completed").otherwise("Pending").alias("status_standardized"),
        done.cast("int").alias("is_completed"),
    )


def pharmacy_inventory_facts(pharmacy: DataFrame, as_of: datetime) -> DataFrame:
    """DOC-07: value, days to expiry, expiring (0..30 days), low stock (strict <)."""
    days = F.datediff(F.col("expiry_date"), F.lit(as_of.date()))
    low = F.col("current_stock") < F.col("threshold")
    soon = (days >= 0) & (days <= 30)
    return pharmacy.select(
        surrogate_key("drug_id", F.lit(as_of.date())).alias("inventory_key"),
        "drug_id",
        "drug_name",
        F.lit(as_of.date()).alias("snapshot_date"),
        F.lit(int(as_of.strftime("%Y%m%d"))).alias("snapshot_date_key"),
        F.col("current_stock").alias("stock_on_hand"),
        F.col("threshold").alias("reorder_level"),
        "unit_price",
        (F.col("current_stock") * F.col("unit_price")).alias("stock_value"),
        days.alias("days_until_expiry"),
        soon.alias("expiring_soon"),
        low.alias("low_stock"),
        low.cast("int").alias("low_stock_flag"),
        soon.cast("int").alias("expiring_soon_flag"),
    )


# ------------------------------------------------------------------ DOC-11 / DOC-12 / DOC-13

def patient_care_daily(vital_facts: DataFrame, lab_facts: DataFrame) -> DataFrame:
    """DOC-11: per day critical readings and lab completion, full outer join."""
    v = vital_facts.groupBy(F.col("measurement_date_key").alias("date_key")).agg(
        F.count_if("is_critical").alias("critical_vitals_count"),
        F.countDistinct(F.when(F.col("is_critical"), F.col("patient_id"))).alias("patients_with_critical_vitals"),
        stable(F.avg("ews_score")).alias("avg_ews_score"),
    )
    lab = lab_facts.groupBy(F.col("sample_date_key").alias("date_key")).agg(
        F.sum("is_completed").cast("bigint").alias("completed_tests"),
        stable(F.avg("turnaround_minutes")).alias("avg_turnaround_minutes"),
        F.count_if("is_delayed").alias("delayed_tests_count"),
    )
    return v.join(lab, "date_key", "full")


def pharmacy_kpi(inv_facts: DataFrame) -> DataFrame:
    """DOC-12: one row per snapshot."""
    return inv_facts.groupBy("snapshot_date_key").agg(
        F.count(F.lit(1)).alias("total_drugs"),
        stable(F.sum("stock_value")).alias("total_inventory_value"),
        F.count_if("low_stock").alias("low_stock_items"),
        F.count_if("expiring_soon").alias("expiring_soon_items"),
        stable(F.avg("days_until_expiry")).alias("avg_days_until_expiry"),
        F.round(F.try_divide(F.count_if("low_stock").cast("double") * 100.0, F.count(F.lit(1)).cast("double")), 2).alias("low_stock_percentage"),
    )


def patient_summary_extended(dim_std: DataFrame, adm_facts: DataFrame, vital_facts: DataFrame) -> DataFrame:
    """DOC-13: per-patient aggregates, each reduced before its left join."""
    a = adm_facts.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_admissions"),
        F.sum("is_discharged").cast("bigint").alias("total_discharges"),
        F.avg("triage_level").alias("avg_triage_level"),
    )
    v = vital_facts.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_vital_readings"),
        F.count_if("is_critical").alias("critical_readings_count"),
        F.avg("ews_score").alias("avg_ews_score"),
        F.avg("heart_rate").alias("avg_heart_rate"),
    )
    out = dim_std.join(a, "patient_id", "left").join(v, "patient_id", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "patient_key",
        "patient_id",
        "first_name",
        "last_name",
        "age",
        "gender_standardized",
        F.coalesce("total_admissions", zero).alias("total_admissions"),
        F.coalesce("total_discharges", zero).alias("total_discharges"),
        F.round("avg_triage_level", 2).alias("avg_triage_level"),
        F.coalesce("total_vital_readings", zero).alias("total_vital_readings"),
        F.coalesce("critical_readings_count", zero).alias("critical_readings_count"),
        F.round("avg_ews_score", 2).alias("avg_ews_score"),
        F.round("avg_heart_rate", 2).alias("avg_heart_rate"),
    )


# ------------------------------------------------------------------ DOC-14

def dictionary_rules(adm_facts: DataFrame, pharmacy: DataFrame, vital_facts: DataFrame, dim_std: DataFrame) -> DataFrame:
    """DOC-14: rule checks of the data dictionary, one scan per table."""
    adm = run_row_checks(adm_facts, "rules_admissions", [
        RowCheck("discharge_before_admission", ISSUE, F.col("discharge_timestamp") < F.col("admission_timestamp"), "%d discharges before admission"),
        RowCheck("triage_out_of_range", ISSUE, ~F.col("triage_level").between(1, 5), "%d triage levels outside 1-5"),
        RowCheck("active_without_ward", ISSUE, (F.col("admission_status") == "Active") & F.col("ward_id").isNull(), "%d active admissions without ward"),
    ])
    ph = run_row_checks(pharmacy, "rules_pharmacy", [
        RowCheck("negative_stock", ISSUE, F.col("current_stock") < 0, "%d negative stock quantities"),
        RowCheck("non_positive_price", ISSUE, F.col("unit_price") <= 0, "%d non-positive unit prices"),
    ])
    vit = run_row_checks(vital_facts, "rules_vitals", [
        RowCheck("heart_rate_range", ISSUE, ~F.col("heart_rate").between(30, 250), "%d heart rates outside 30-250"),
        RowCheck("spo2_range", ISSUE, ~F.col("oxygen_saturation").between(70, 100), "%d oxygen saturations outside 70-100"),
        RowCheck("temperature_range", ISSUE, ~F.col("temperature").between(30, 45), "%d temperatures outside 30-45"),
        RowCheck("systolic_not_above_diastolic", ISSUE, F.col("blood_pressure_systolic") <= F.col("blood_pressure_diastolic"), "%d readings with systolic <= diastolic"),
    ])
    pat = run_row_checks(dim_std, "rules_patients", [
        RowCheck("age_out_of_range", ISSUE, ~F.col("age_valid"), "%d ages outside 0-120"),
        RowCheck("gender_not_standard", ISSUE, ~F.col("gender_standardized").isin("M", "F", "O"), "%d non-standard genders"),
    ])
    return union_all([adm, ph, vit, pat])
