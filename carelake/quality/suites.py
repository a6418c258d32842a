"""Validation suites (VS-01..17) as check lists over DataFrames.

Each suite returns the check rows of ``carelake.quality.checks``.  Row-level
rules of a suite, its row count and its empty check share one aggregate;
each keyed rule adds one grouped pass.
Thresholds are configurable; a given config is merged over the defaults.
Message texts follow the reference's wording.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_years_365, shift_days, shift_years, ts_lit
from ..functions.lab_ranges import REFERENCE_RANGES, classify, must_be_positive
from ..functions.parse import lenient_double, lenient_timestamp
from ..functions.text import has_unusual_chars, has_valid_id_format, is_blank, is_digits_only, strip, text_length
from ..operators import profile
from .checks import ISSUE, WARNING, RowCheck, metric_check, run_row_checks, static_check, union_all

# Fixed default thresholds (reference values).
RECORDS_DEFAULTS = {
    "critical_issue_threshold": 0.05,
    "warning_threshold": 0.10,
    "max_future_years": 1,
    "min_patient_age": 0,
    "max_patient_age": 120,
    "min_ward_capacity": 1,
    "max_ward_capacity": 200,
}
PHARMACY_DEFAULTS = {
    "critical_issue_threshold": 0.01,
    "expired_drug_tolerance": 0,
    "min_quantity": 0,
    "max_quantity": 10000,
    "high_quantity_threshold": 1000,
    "expiry_buffer_days": 30,
}
LAB_DEFAULTS = {
    "critical_issue_threshold": 0.05,
    "future_date_tolerance_days": 7,
    "max_age_years": 10,
    "outlier_sd_threshold": 4,
    "min_result_value": 0,
    "consistency_threshold": 0.9,
}
# Known drug categories (case-sensitive).
KNOWN_DRUG_CATEGORIES = ["antibiotic", "analgesic", "antiviral", "antifungal", "vaccine", "insulin", "chemotherapy", "anesthetic"]

REQUIRED = {
    "patients": ["patient_id", "first_name", "last_name", "date_of_birth"],
    "admissions": ["admission_id", "patient_id", "admission_date", "ward_id"],
    "discharges": ["discharge_id", "patient_id", "discharge_date"],
    "wards": ["ward_id", "ward_name"],
    "pharmacy": ["drug_id", "drug_name", "quantity", "expiry_date"],
    "lab_results": ["patient_id", "test_type", "test_date", "result_value"],
}


def _cfg(defaults: dict, config: dict | None) -> dict:
    out = dict(defaults)
    out.update(config or {})
    return out


def _schema_check(df: DataFrame, suite: str, table: str):
    missing = [c for c in REQUIRED[table] if c not in df.columns]
    msg = f"Missing required columns: {missing}"
    return static_check(df.sparkSession, suite, "missing_columns", ISSUE, len(missing), msg), missing


def _pk_checks(key: str, prefix: str = "") -> list[RowCheck]:
    return [RowCheck("pk_null", ISSUE, F.col(key).isNull(), f"%d null values in primary key {key}")]


def _pk_duplicates(df: DataFrame, suite: str, key: str, message: str) -> DataFrame:
    one = profile.surplus_duplicates(df, key)
    return metric_check(one, suite, "pk_duplicate", ISSUE, F.col("surplus_rows"), F.format_string(message, F.col("surplus_rows")))


# ------------------------------------------------------------------ records (VS-01..04)

def validate_patients(df: DataFrame, as_of: datetime, config: dict | None = None) -> DataFrame:
    """VS-01."""
    cfg = _cfg(RECORDS_DEFAULTS, config)
    suite = "patients"
    schema, _missing = _schema_check(df, suite, "patients")
    frames = [schema]
    checks: list[RowCheck] = []
    if "patient_id" in df.columns:
        checks += _pk_checks("patient_id")
        checks.append(RowCheck("id_format", ISSUE, ~has_valid_id_format("patient_id"), "%d patient IDs with invalid format"))
        frames.append(_pk_duplicates(df, suite, "patient_id", "%d duplicate values in primary key patient_id"))
    if "date_of_birth" in df.columns:
        dob = lenient_timestamp("date_of_birth")
        yrs = cfg["max_future_years"]
        now, far = ts_lit(as_of), ts_lit(shift_years(as_of, yrs))
        checks += [
            RowCheck("dob_invalid", ISSUE, dob.isNull(), "%d invalid date formats in date_of_birth"),
            RowCheck("dob_future_far", ISSUE, dob > far, f"%d patients with birth dates >{yrs} years in future"),
            RowCheck("dob_future_near", WARNING, (dob > now) & (dob <= far), f"%d patients with future birth dates (within {yrs} years)"),
            RowCheck("dob_very_old", WARNING, dob < ts_lit(shift_years(as_of, -120)), "%d patients older than 120 years"),
        ]
        age = age_years_365(dob, as_of)
        lo, hi = cfg["min_patient_age"], cfg["max_patient_age"]
        checks += [
            RowCheck("age_too_young", WARNING, age < lo, f"%d patients with age < {lo}"),
            RowCheck("age_too_old", WARNING, age > hi, f"%d patients with age > {hi}"),
        ]
    for col in ("first_name", "last_name"):
        if col in df.columns:
            checks += [
                RowCheck(f"{col}_empty", WARNING, is_blank(col), f"%d empty {col} values"),
                RowCheck(f"{col}_unusual", WARNING, has_unusual_chars(col), f"%d {col} values with unusual characters"),
            ]
    frames.insert(0, run_row_checks(df, suite, checks, "Table is empty"))
    return union_all(frames)


def validate_admissions(df: DataFrame, as_of: datetime, config: dict | None = None) -> DataFrame:
    """VS-02."""
    suite = "admissions"
    schema, _ = _schema_check(df, suite, "admissions")
    frames = [schema]
    checks: list[RowCheck] = []
    if "admission_id" in df.columns:
        checks += _pk_checks("admission_id")
        frames.append(_pk_duplicates(df, suite, "admission_id", "%d duplicate values in primary key admission_id"))
    if "patient_id" in df.columns:
        checks.append(RowCheck("patient_null", ISSUE, F.col("patient_id").isNull(), "%d admissions missing patient_id"))
    if "admission_date" in df.columns:
        t = lenient_timestamp("admission_date")
        checks += [
            RowCheck("date_invalid", ISSUE, t.isNull(), "%d invalid admission dates"),
            RowCheck("date_future", WARNING, t > ts_lit(as_of), "%d future admission dates"),
            RowCheck("date_old", WARNING, t < ts_lit(shift_years(as_of, -2)), "%d admissions older than 2 years"),
        ]
    frames.insert(0, run_row_checks(df, suite, checks, "Table is empty"))
    return union_all(frames)


def validate_discharges(df: DataFrame, as_of: datetime, config: dict | None = None) -> DataFrame:
    """VS-03."""
    suite = "discharges"
    schema, _ = _schema_check(df, suite, "discharges")
    frames = [schema]
    checks: list[RowCheck] = []
    if "discharge_id" in df.columns:
        checks += _pk_checks("discharge_id")
        frames.append(_pk_duplicates(df, suite, "discharge_id", "%d duplicate values in primary key discharge_id"))
    if "discharge_date" in df.columns:
        checks.append(RowCheck("date_invalid", ISSUE, lenient_timestamp("discharge_date").isNull(), "%d invalid discharge dates"))
    frames.insert(0, run_row_checks(df, suite, checks, "Table is empty"))
    return union_all(frames)


def validate_wards(df: DataFrame, as_of: datetime, config: dict | None = None) -> DataFrame:
    """VS-04: negative capacities count as negative and as unrealistic."""
    cfg = _cfg(RECORDS_DEFAULTS, config)
    suite = "wards"
    schema, _ = _schema_check(df, suite, "wards")
    frames = [schema]
    checks: list[RowCheck] = []
    if "ward_id" in df.columns:
        checks += _pk_checks("ward_id")
        frames.append(_pk_duplicates(df, suite, "ward_id", "%d duplicate values in primary key ward_id"))
    if "capacity" in df.columns:
        cap = lenient_double("capacity")
        lo, hi = cfg["min_ward_capacity"], cfg["max_ward_capacity"]
        checks += [
            RowCheck("capacity_negative", ISSUE, cap < 0, "%d wards with negative capacity"),
            RowCheck("capacity_unrealistic", ISSUE, (cap < lo) | (cap > hi), "%d wards with unrealistic capacity"),
        ]
    frames.insert(0, run_row_checks(df, suite, checks, "Table is empty"))
    return union_all(frames)


# ------------------------------------------------------------------ pharmacy (VS-06)

def _grouped_counts(df: DataFrame, key: str, checks: list[RowCheck], extra: list) -> DataFrame:
    """One grouped pass: per ``key`` value, the row count, every row-check
    count and ``extra`` aggregates.  Partial aggregation happens map-side, so
    the shuffle carries one row per key value and map task."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(c.predicate).alias(f"_c{i}") for i, c in enumerate(checks)], *extra
    )


def _totals(g: DataFrame, checks: list[RowCheck], extra: tuple[str, ...] = ()) -> DataFrame:
    return g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_n"),
        *[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).cast("bigint").alias(f"_c{i}") for i in range(len(checks))],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in extra],
    )


def validate_pharmacy(df: DataFrame, as_of: datetime, config: dict | None = None) -> DataFrame:
    """VS-06: a missing required column stops the suite.

    Row checks, the empty check and the category checks come from one
    pass grouped by category; duplicate ids add one keyed pass.
    """
    cfg = _cfg(PHARMACY_DEFAULTS, config)
    suite = "pharmacy"
    schema, missing = _schema_check(df, suite, "pharmacy")
    if missing:
        return union_all([run_row_checks(df, suite, [], "Drug inventory data is empty"), schema])
    q = lenient_double("quantity")
    e = lenient_timestamp("expiry_date")
    now = ts_lit(as_of)
    buf = cfg["expiry_buffer_days"]
    hi, mx, mn = cfg["high_quantity_threshold"], cfg["max_quantity"], cfg["min_quantity"]
    tol = cfg["expired_drug_tolerance"]
    checks = [
        RowCheck("null_drug_id", ISSUE, F.col("drug_id").isNull(), "Found %d null drug IDs"),
        RowCheck("null_drug_name", ISSUE, F.col("drug_name").isNull(), "Found %d null drug names"),
        RowCheck("empty_drug_name", WARNING, is_blank("drug_name"), "Found %d empty drug names"),
        RowCheck("short_drug_name", WARNING, text_length("drug_name") < 2, "Found %d very short drug names (< 2 chars)"),
        RowCheck("numeric_drug_name", WARNING, is_digits_only("drug_name"), "Found %d drug names that are only numbers"),
        RowCheck("quantity_negative", ISSUE, q < mn, "Found %d drugs with negative quantity"),
        RowCheck("quantity_high", WARNING, q > hi, f"Found %d drugs with unusually high quantity (> {hi})"),
        RowCheck("quantity_over_max", ISSUE, q > mx, f"Found %d drugs exceeding maximum quantity ({mx})"),
        RowCheck("quantity_zero", WARNING, q == 0, "Found %d drugs with zero quantity (may be out of stock)"),
        RowCheck("quantity_non_numeric", ISSUE, q.isNull(), "Found %d drugs with non-numeric quantity values"),
        RowCheck("expiry_invalid", ISSUE, e.isNull(), "Found %d drugs with invalid expiry date format"),
        RowCheck("expired", ISSUE, e < now, f"Found %d expired drugs (tolerance: {tol})", tolerance=tol),
        RowCheck("expiring_soon", WARNING, (e >= now) & (e <= ts_lit(shift_days(as_of, buf))), f"Found %d drugs expiring within {buf} days"),
        RowCheck("expiry_far_future", WARNING, e > ts_lit(as_of + timedelta(days=365 * 5)), "Found %d drugs with expiry dates >5 years in future"),
        RowCheck("expiry_before_2000", ISSUE, e < ts_lit(datetime(2000, 1, 1)), "Found %d drugs with expiry dates before 2000"),
    ]
    has_cat = "category" in df.columns
    if has_cat:
        checks.append(RowCheck("category_missing", WARNING, is_blank("category"), "Found %d drugs without category"))
        g = _grouped_counts(df, "category", checks, [])
        counts = _totals(g, checks)
    else:
        counts = None
    frames = [run_row_checks(df, suite, checks, "Drug inventory data is empty", counts=counts), schema]
    frames.append(_pk_duplicates(df, suite, "drug_id", "Found %d duplicate drug IDs"))
    if has_cat:
        unknown = g.filter(F.col("category").isNotNull() & ~F.col("category").isin(KNOWN_DRUG_CATEGORIES))
        sample = profile.distinct_sample(unknown, "category", 5).agg(F.sort_array(F.collect_list("value")).alias("s"))
        counted = profile.attach_scalar(unknown.agg(F.count(F.lit(1)).alias("n")), sample)
        msg = F.concat(F.lit("Found unknown drug categories: ['"), F.array_join("s", "', '"), F.lit("']"))
        frames.append(metric_check(counted, suite, "category_unknown", WARNING, F.col("n"), msg))
    return union_all(frames)


# ------------------------------------------------------------------ labs (VS-08)

def validate_lab_results(df: DataFrame, as_of: datetime, config: dict | None = None) -> DataFrame:
    """VS-08: a missing required column stops the suite.

    One pass grouped by test type yields the row checks, the empty check,
    rare types, non-numeric results and the per-class statistics (merged
    from per-type count, mean and variance); outliers, same-time tests and
    test intervals add one pass each.
    """
    cfg = _cfg(LAB_DEFAULTS, config)
    suite = "lab_results"
    schema, missing = _schema_check(df, suite, "lab_results")
    if missing:
        return union_all([run_row_checks(df, suite, [], "Lab results data is empty"), schema])
    d = lenient_timestamp("test_date")
    x = lenient_double("result_value")
    now = ts_lit(as_of)
    days = cfg["future_date_tolerance_days"]
    yrs = cfg["max_age_years"]
    cutoff = ts_lit(shift_days(as_of, days))
    pid_len = text_length("patient_id")
    checks = [
        RowCheck("patient_null", ISSUE, F.col("patient_id").isNull(), "Found %d tests without patient ID"),
        RowCheck("patient_format", WARNING, ~has_valid_id_format("patient_id"), "Found %d tests with unusual patient ID format"),
        RowCheck("patient_length", WARNING, (pid_len < 3) | (pid_len > 20), "Found %d tests with unusual patient ID length"),
        RowCheck("test_type_null", ISSUE, F.col("test_type").isNull(), "Found %d tests without test type"),
        RowCheck("test_type_empty", ISSUE, strip("test_type") == "", "Found %d tests with empty test type"),
        RowCheck("date_invalid", ISSUE, d.isNull(), "Found %d tests with invalid date format"),
        RowCheck("date_future_far", ISSUE, d > cutoff, f"Found %d tests with dates >{days} days in future"),
        RowCheck("date_future_near", WARNING, (d > now) & (d <= cutoff), f"Found %d tests with dates up to {days} days in future"),
        RowCheck("date_old", WARNING, d < ts_lit(shift_years(as_of, -yrs)), f"Found %d tests older than {yrs} years"),
        RowCheck("result_null", WARNING, F.col("result_value").isNull(), "Found %d tests with null results"),
        RowCheck("result_negative", ISSUE, x.isNotNull() & must_be_positive("test_type") & (x < cfg["min_result_value"]),
                 "Found %d tests with negative values (should be positive)"),
    ]
    cls = classify("test_type")
    lo = F.element_at(_range_bound(1), cls)
    hi = F.element_at(_range_bound(2), cls)
    g = _grouped_counts(df, "test_type", checks, [
        F.count_if(x.isNull() & F.col("result_value").isNotNull()).alias("_nonnum"),
        F.count(x).alias("_xn"),
        F.avg(x).alias("_xmean"),
        F.var_samp(x).alias("_xvar"),
        F.count_if(x < lo).alias("_below"),
        F.count_if(x > hi).alias("_above"),
    ])
    totals = _totals(g, checks, ("_nonnum",))
    frames = [run_row_checks(df, suite, checks, "Lab results data is empty", counts=totals.drop("_nonnum")), schema]

    # non-numeric results, with up to five of their test types
    types = profile.distinct_sample(g.filter(F.col("_nonnum") > 0), "test_type", 5).agg(F.sort_array(F.collect_list("value")).alias("s"))
    counted = profile.attach_scalar(totals.select(F.col("_nonnum").alias("n")), types)
    msg = F.concat(F.lit("Found "), F.col("n").cast("string"), F.lit(" non-numeric results for test types: ['"), F.array_join("s", "', '"), F.lit("']"))
    frames.append(metric_check(counted, suite, "result_non_numeric", WARNING, F.col("n"), msg))

    # rare test types: count below max(1, rows * 0.1 %)
    rare = profile.attach_scalar(g.filter(F.col("test_type").isNotNull()), totals.select(F.col("_n").alias("_rows")))
    rare = rare.agg(F.count_if(F.col("_n") < F.greatest(F.lit(1.0), F.col("_rows") * F.lit(0.001))).alias("n"))
    frames.append(metric_check(rare, suite, "test_type_rare", WARNING, F.col("n"), F.format_string("Found %d very rare test types (potential typos)", F.col("n"))))

    timed = df.select("patient_id", d.alias("_t"))
    same = profile.same_time_groups(timed, "patient_id", "_t")
    frames.append(metric_check(same, suite, "same_time_tests", WARNING, F.col("multi_test_groups"),
                               F.format_string("Found %d patient-date combinations with multiple tests", F.col("multi_test_groups"))))
    freq = profile.frequent_tests(timed, "patient_id", "_t")
    frames.append(metric_check(freq, suite, "frequent_tests", WARNING, F.col("frequent_tests"),
                               F.format_string("Found %d tests with <1 day interval", F.col("frequent_tests"))))

    stats = _merge_class_stats(g.withColumn("range_name", classify("test_type")))
    abnormal = stats.select(
        F.concat(F.lit("abnormal_"), F.col("range_name")).alias("check"),
        F.when(F.col("total_abnormal") / F.col("count") > 0.5, F.lit(ISSUE)).otherwise(F.lit(WARNING)).alias("severity"),
        F.col("total_abnormal").alias("failed"),
        (F.col("total_abnormal") > 0).alias("fired"),
        F.format_string("%s: %d abnormal results (%.1f%%)", F.col("range_name"), F.col("total_abnormal"),
                        F.col("total_abnormal") / F.col("count") * 100).alias("message"),
    )
    frames.append(abnormal.select(F.lit(suite).alias("suite"), "*").withColumn("message", F.when(F.col("fired"), F.col("message"))))

    sd = cfg["outlier_sd_threshold"]
    rows = df.select(classify("test_type").alias("range_name"), x.alias("_x")).filter(F.col("_x").isNotNull() & F.col("range_name").isNotNull())
    joined = rows.join(F.broadcast(stats.select("range_name", "count", "mean", "std")), "range_name")
    flagged = (F.col("count") > 10) & (F.col("std") > 0) & (F.abs(F.col("_x") - F.col("mean")) > F.lit(sd) * F.col("std"))
    outl = joined.groupBy("range_name").agg(F.count_if(flagged).alias("outliers")).select(
        F.concat(F.lit("outliers_"), F.col("range_name")).alias("check"),
        F.lit(WARNING).alias("severity"),
        F.col("outliers").cast("bigint").alias("failed"),
        (F.col("outliers") > 0).alias("fired"),
        F.format_string("%s: %d extreme outliers", F.col("range_name"), F.col("outliers")).alias("message"),
    )
    frames.append(outl.select(F.lit(suite).alias("suite"), "*").withColumn("message", F.when(F.col("fired"), F.col("message"))))
    return union_all(frames)


def _range_bound(idx: int):
    """Map expression range name -> bound (1 = min, 2 = max)."""
    return F.create_map(*[x for r in REFERENCE_RANGES for x in (F.lit(r[0]), F.lit(r[idx]))])


def _merge_class_stats(g: DataFrame) -> DataFrame:
    """Class-level count, mean, sample std, below/above from per-type partials.

    Sample variance is merged exactly: M2 = sum(M2_i) + sum(n_i (mean_i - mean)^2).
    At most one row per class (12) results.
    """
    per = g.filter(F.col("range_name").isNotNull() & (F.col("_xn") > 0))
    c1 = per.groupBy("range_name").agg(
        F.sum("_xn").alias("count"),
        (F.sum(F.col("_xmean") * F.col("_xn")) / F.sum("_xn")).alias("mean"),
        F.sum(F.coalesce(F.col("_xvar"), F.lit(0.0)) * (F.col("_xn") - 1)).alias("_m2w"),
        F.sum("_below").alias("below"),
        F.sum("_above").alias("above"),
    )
    spread = per.join(c1.select("range_name", F.col("mean").alias("_cm")), "range_name").groupBy("range_name").agg(
        F.sum(F.col("_xn") * (F.col("_xmean") - F.col("_cm")) * (F.col("_xmean") - F.col("_cm"))).alias("_m2b")
    )
    out = c1.join(spread, "range_name")
    std = F.when(F.col("count") > 1, F.sqrt((F.col("_m2w") + F.col("_m2b")) / (F.col("count") - 1)))
    return out.select(
        "range_name", F.col("count").cast("bigint").alias("count"), "mean", std.alias("std"),
        (F.col("below") + F.col("above")).cast("bigint").alias("total_abnormal"),
    )


# ------------------------------------------------------------------ silver (VS-11..14)

def validate_silver(table: str, df: DataFrame, as_of: datetime) -> DataFrame:
    """VS-11..14: checks on conditioned tables; every finding is an issue
    except future admissions (warning)."""
    suite = f"silver_{table}"
    now = ts_lit(as_of)
    today = F.lit(as_of.date())
    frames = []
    checks: list[RowCheck] = []
    if table == "patients":
        checks.append(RowCheck("null_patient_id", ISSUE, F.col("patient_id").isNull(), "%d null patient_ids"))
        if "date_of_birth" in df.columns:
            checks.append(RowCheck("future_birth", ISSUE, F.col("date_of_birth") > today, "%d future birth dates"))
        dup = profile.duplicate_groups(df, ["patient_id"])
        frames.append(metric_check(dup, suite, "duplicate_patient_id", ISSUE, F.col("duplicate_groups"),
                                   F.format_string("%d duplicate patient_ids", F.col("duplicate_groups"))))
    elif table == "admissions":
        checks.append(RowCheck("null_admission_id", ISSUE, F.col("admission_id").isNull(), "%d null admission_ids"))
        if "admission_time" in df.columns:
            checks.append(RowCheck("future_admission", WARNING, F.col("admission_time") > now, "%d future admission dates (scheduled?)"))
    elif table == "pharmacy_inventory":
        if "stock_on_hand" in df.columns:
            checks.append(RowCheck("negative_stock", ISSUE, F.col("stock_on_hand") < 0, "%d negative stock values"))
        if "expiry_date" in df.columns:
            checks.append(RowCheck("expired", ISSUE, F.col("expiry_date") < today, "%d expired drugs"))
    elif table == "lab_results":
        checks.append(RowCheck("null_test_type", ISSUE, F.col("test_type").isNull(), "%d null test types"))
        if "sample_datetime" in df.columns:
            checks.append(RowCheck("future_test", ISSUE, F.col("sample_datetime") > now, "%d future test dates"))
    frames.insert(0, run_row_checks(df, suite, checks))
    return union_all(frames)


# ------------------------------------------------------------------ gold (VS-15..17)

def validate_gold(table: str, df: DataFrame) -> DataFrame:
    """VS-15..17 by table-name prefix."""
    suite = f"gold_{table}"
    frames = []
    checks: list[RowCheck] = []
    if table.startswith("dim_"):
        key = "patient_key" if "patient_key" in df.columns else ("ward_key" if "ward_key" in df.columns else None)
        if key:
            checks.append(RowCheck("null_key", ISSUE, F.col(key).isNull(), "%d null values in dimension key"))
        if "patient_key" in df.columns:
            dup = profile.duplicate_groups(df, ["patient_key"])
            frames.append(metric_check(dup, suite, "duplicate_key", ISSUE, F.col("duplicate_groups"),
                                       F.format_string("%d duplicate patient keys", F.col("duplicate_groups"))))
            if table == "dim_patient":
                u = profile.key_uniqueness(df, "patient_key")
                frames.append(metric_check(u, suite, "key_uniqueness", ISSUE, F.col("total_rows") - F.col("unique_keys"),
                                           F.format_string("Dimension keys not unique: %d rows, %d unique keys", F.col("total_rows"), F.col("unique_keys"))))
    elif table.startswith("fact_"):
        if "patient_id" in df.columns:
            checks.append(RowCheck("null_patient_id", ISSUE, F.col("patient_id").isNull(), "%d null patient_ids in fact table"))
        if table == "fact_admissions" and "admission_id" in df.columns:
            checks.append(RowCheck("null_admission_id", ISSUE, F.col("admission_id").isNull(), "%d null admission_ids"))
        if table == "fact_pharmacy" and "stock_on_hand" in df.columns:
            checks.append(RowCheck("negative_stock", ISSUE, F.col("stock_on_hand") < 0, "%d negative stock values"))
            if "reorder_level" in df.columns:
                # a metric, never an issue (strict '<', unlike the KPI's '<=')
                checks.append(RowCheck("needs_reorder", "metric", F.col("stock_on_hand") < F.col("reorder_level"), "%d items need reorder", tolerance=2**62))
    elif table == "patient_summary":
        if "total_admissions" in df.columns:
            checks.append(RowCheck("negative_admissions", ISSUE, F.col("total_admissions") < 0, "%d negative admission counts"))
        if "age" in df.columns:
            checks.append(RowCheck("invalid_age", ISSUE, (F.col("age") < 0) | (F.col("age") > 120), "%d invalid age values"))
    elif table == "daily_admissions_summary":
        if "daily_admissions" in df.columns:
            checks.append(RowCheck("negative_daily", ISSUE, F.col("daily_admissions") < 0, "%d negative daily admissions"))
        if "unique_patients" in df.columns and "daily_admissions" in df.columns:
            checks.append(RowCheck("illogical_unique", ISSUE, F.col("unique_patients") > F.col("daily_admissions"),
                                   "%d rows where unique_patients > daily_admissions"))
    frames.insert(0, run_row_checks(df, suite, checks))
    return union_all(frames)
