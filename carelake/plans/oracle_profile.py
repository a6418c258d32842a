"""Oracle statements for profiling, integrity and validation suites."""

from __future__ import annotations

from .oracle_more import ldouble, lts
from .oracle_sql import ADM_AS_OF, LAB_AS_OF, ORACLE, VIEWS, skey, ts_text, with_views  # noqa: F401

RANGES = [
    ("glucose", 70.0, 140.0), ("cholesterol", 125.0, 200.0), ("hemoglobin", 13.5, 17.5), ("wbc", 4.5, 11.0),
    ("rbc", 4.7, 6.1), ("platelets", 150.0, 450.0), ("sodium", 135.0, 145.0), ("potassium", 3.5, 5.0),
    ("creatinine", 0.6, 1.2), ("alt", 7.0, 56.0), ("ast", 10.0, 40.0), ("bilirubin", 0.1, 1.2),
]


def classify_sql(e: str) -> str:
    whens = " ".join(f"WHEN lower(trim({e})) LIKE '%{n}%' THEN '{n}'" for n, _, _ in RANGES)
    return f"(CASE {whens} END)"


def bound_sql(e: str, idx: int) -> str:
    whens = " ".join(f"WHEN '{r[0]}' THEN {r[idx]}" for r in RANGES)
    return f"(CASE {e} {whens} END)"


# ---------------------------------------------------------------- keys, distributions, statistics

ORACLE["agg_08_duplicate_groups"] = """SELECT CAST(count(*) AS BIGINT) AS duplicate_groups FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)"""

ORACLE["agg_09_duplicate_rows"] = with_views(
    ["bronze_pharmacy"],
    """SELECT CAST(count(*) - count(DISTINCT drug_id) - max(CASE WHEN drug_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS surplus_rows
FROM bronze_pharmacy""",
)

ORACLE["agg_10_key_uniqueness"] = with_views(
    ["silver_patients_dirty"],
    """SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(DISTINCT patient_id) + max(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_keys,
       count(*) = count(DISTINCT patient_id) + max(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END) AS keys_unique
FROM silver_patients_dirty""",
)

ORACLE["agg_11_distribution"] = with_views(
    ["pharmacy_inventory"],
    "SELECT category AS value, CAST(count(*) AS BIGINT) AS count FROM pharmacy_inventory WHERE category IS NOT NULL GROUP BY 1",
)

ORACLE["agg_12_rare_values"] = with_views(
    ["admissions"],
    """SELECT patient_id AS value, CAST(count(*) AS BIGINT) AS count FROM admissions WHERE patient_id IS NOT NULL GROUP BY 1
HAVING count(*) < greatest(1.0, (SELECT count(*) FROM admissions) * 0.001)""",
)

ORACLE["top_01_top_wards"] = with_views(
    ["admissions"],
    """SELECT ward_id AS value, CAST(count(*) AS BIGINT) AS count FROM admissions WHERE ward_id IS NOT NULL
GROUP BY 1 ORDER BY count DESC, value ASC LIMIT 10""",
)

ORACLE["set_02_unknown_categories"] = with_views(
    ["bronze_pharmacy"],
    """SELECT DISTINCT category AS value FROM bronze_pharmacy WHERE category IS NOT NULL
AND category NOT IN ('antibiotic', 'analgesic', 'antiviral', 'antifungal', 'vaccine', 'insulin', 'chemotherapy', 'anesthetic')""",
)

ORACLE["agg_23_distinct_sample"] = with_views(
    ["pharmacy_inventory"],
    "SELECT DISTINCT drug_name AS value FROM pharmacy_inventory WHERE drug_name IS NOT NULL ORDER BY 1 LIMIT 5",
)

ORACLE["lim_01_extract_limit"] = with_views(["patients"], "SELECT * FROM patients ORDER BY patient_id LIMIT 1000")

ORACLE["agg_13_date_range"] = with_views(
    ["admissions"],
    """SELECT strftime(min(admission_time), '%Y-%m-%dT%H:%M:%S') AS earliest,
       strftime(max(admission_time), '%Y-%m-%dT%H:%M:%S') AS latest FROM admissions""",
)

ORACLE["agg_14_quantity"] = with_views(
    ["bronze_pharmacy"],
    f"SELECT sum({ldouble('quantity')}) AS total_quantity, avg({ldouble('quantity')}) AS avg_quantity FROM bronze_pharmacy",
)

ORACLE["agg_15_result_statistics"] = with_views(
    ["lab_results"],
    """SELECT round(avg(result_value), 6) AS mean, round(median(result_value), 6) AS median,
       round(stddev_samp(result_value), 6) AS std,
       CAST(min(result_value) AS DOUBLE) AS min, CAST(max(result_value) AS DOUBLE) AS max FROM lab_results""",
)

ORACLE["agg_16_tests_per_day"] = with_views(
    ["bronze_lab_results"],
    f"""SELECT CAST(count({lts('test_date')}) AS DOUBLE) / count(DISTINCT CAST({lts('test_date')} AS DATE)) AS avg_tests_per_day
FROM bronze_lab_results""",
)

ORACLE["agg_17_distinct_counts"] = with_views(
    ["bronze_lab_results"],
    """SELECT CAST(count(DISTINCT patient_id) AS BIGINT) AS unique_patient_id, CAST(count(DISTINCT test_type) AS BIGINT) AS unique_test_type
FROM bronze_lab_results""",
)

ORACLE["agg_22_average_age"] = with_views(
    ["patients"],
    f"""SELECT round(avg(floor((epoch({ADM_AS_OF}) - epoch(CAST(date_of_birth AS TIMESTAMP))) / 86400)) / 365.25, 2) AS average_age
FROM patients""",
)

_CLASS_STATS = f"""
SELECT range_name, CAST(count(*) AS BIGINT) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       CAST(count_if(x < {bound_sql('range_name', 1)}) AS BIGINT) AS below_range,
       CAST(count_if(x > {bound_sql('range_name', 2)}) AS BIGINT) AS above_range
FROM (SELECT {classify_sql('test_type')} AS range_name, result_value AS x FROM lab_results WHERE result_value IS NOT NULL)
WHERE range_name IS NOT NULL GROUP BY 1"""

ORACLE["agg_18_reference_ranges"] = with_views(
    ["lab_results"],
    f"""SELECT *, below_range + above_range AS total_abnormal,
       round(CAST(below_range + above_range AS DOUBLE) / count, 6) AS abnormal_pct,
       CASE WHEN below_range + above_range = 0 THEN NULL
            WHEN CAST(below_range + above_range AS DOUBLE) / count > 0.5 THEN 'issue' ELSE 'warning' END AS severity
FROM ({_CLASS_STATS})""",
)

ORACLE["agg_19_outliers"] = with_views(
    ["lab_results"],
    f"""WITH r AS (SELECT {classify_sql('test_type')} AS range_name,
                      CASE WHEN result_value > 480 THEN result_value * 100 ELSE result_value END AS x
               FROM lab_results),
s AS (SELECT range_name, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS std FROM r
      WHERE x IS NOT NULL AND range_name IS NOT NULL GROUP BY 1)
SELECT r.range_name, CAST(count_if(s.n > 10 AND s.std > 0 AND abs(r.x - s.mean) > 4 * s.std) AS BIGINT) AS outliers
FROM r JOIN s ON r.range_name = s.range_name WHERE r.x IS NOT NULL GROUP BY 1""",
)

ORACLE["fn_17_test_classes"] = with_views(
    ["bronze_lab_results"],
    f"SELECT {classify_sql('test_type')} AS range_name, CAST(count(*) AS BIGINT) AS tests FROM bronze_lab_results GROUP BY 1",
)

ORACLE["agg_24_same_time_tests"] = with_views(
    ["bronze_lab_results"],
    f"""SELECT CAST(count(*) AS BIGINT) AS multi_test_groups FROM (
  SELECT patient_id, {lts('test_date')} AS t FROM bronze_lab_results
  WHERE patient_id IS NOT NULL AND {lts('test_date')} IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)""",
)

_INTERVALS = f"""
SELECT lab_result_id, patient_id, t, prev AS previous_test_time,
       CAST(floor((epoch_us(t) - epoch_us(prev)) / 86400000000.0) AS BIGINT) AS days_since_previous
FROM (SELECT lab_result_id, patient_id, t, lag(t) OVER (PARTITION BY patient_id ORDER BY t, lab_result_id) AS prev
      FROM (SELECT lab_result_id, patient_id, {lts('test_date')} AS t FROM bronze_lab_results)
      WHERE t IS NOT NULL AND patient_id IS NOT NULL)"""

ORACLE["win_01_test_interval"] = with_views(["bronze_lab_results"], _INTERVALS)
ORACLE["win_01_frequent_tests"] = with_views(
    ["bronze_lab_results"], f"SELECT CAST(count_if(days_since_previous < 1) AS BIGINT) AS frequent_tests FROM ({_INTERVALS})"
)

# ---------------------------------------------------------------- integrity

_DIRTY_FACT_ADM = f"""(SELECT admission_id, patient_id, ward_id, coalesce(admission_time, {ADM_AS_OF}) AS admission_time
 FROM silver_admissions_dirty)"""

ORACLE["jn_06_referential_integrity"] = with_views(
    ["silver_admissions_dirty", "silver_patients_dirty", "silver_wards_dirty"],
    f"""WITH f AS {_DIRTY_FACT_ADM},
c AS (
  SELECT 'fact_admissions_patient_integrity' AS "check", CAST(count(*) AS BIGINT) AS missing FROM f
  WHERE patient_id IS NOT NULL AND patient_id NOT IN (SELECT patient_id FROM silver_patients_dirty WHERE patient_id IS NOT NULL)
  UNION ALL
  SELECT 'fact_admissions_ward_integrity', CAST(count(*) AS BIGINT) FROM f
  WHERE ward_id IS NOT NULL AND ward_id NOT IN (SELECT ward_id FROM silver_wards_dirty WHERE ward_id IS NOT NULL))
SELECT "check", missing, CASE WHEN missing = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN max(missing) OVER () > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status FROM c""",
)

# ---------------------------------------------------------------- suites


def row_check(suite: str, table: str, name: str, severity: str, pred: str, msg: str, tol: int = 0) -> str:
    return (
        f"SELECT '{suite}' AS suite, '{name}' AS \"check\", '{severity}' AS severity, failed, failed > {tol} AS fired, "
        f"CASE WHEN failed > {tol} THEN printf('{msg}', failed) END AS message "
        f"FROM (SELECT CAST(count_if({pred}) AS BIGINT) AS failed FROM {table})"
    )


def metric(suite: str, name: str, severity: str, value_sql: str, msg_sql: str, tol: int = 0) -> str:
    return (
        f"SELECT '{suite}' AS suite, '{name}' AS \"check\", '{severity}' AS severity, failed, failed > {tol} AS fired, "
        f"CASE WHEN failed > {tol} THEN {msg_sql} END AS message FROM ({value_sql})"
    )


def rowcount(suite: str, table: str) -> str:
    return metric(suite, "row_count", "metric", f"SELECT CAST(count(*) AS BIGINT) AS failed FROM {table}", "NULL", tol=2**62)


def empty(suite: str, table: str, msg: str) -> str:
    return union([
        metric(suite, "empty", "issue", f"SELECT CAST(count(*) = 0 AS BIGINT) AS failed FROM {table}", f"'{msg}'"),
        rowcount(suite, table),
    ])


def static(suite: str, failed: int, msg: str) -> str:
    m = msg.replace("'", "''")
    return metric(suite, "missing_columns", "issue", f"SELECT CAST({failed} AS BIGINT) AS failed", f"'{m}'")


def surplus(suite: str, table: str, key: str, msg: str) -> str:
    v = (f"SELECT CAST(count(*) - count(DISTINCT {key}) - coalesce(max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) "
         f"AS failed FROM {table}")
    return metric(suite, "pk_duplicate", "issue", v, f"printf('{msg}', failed)")


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


ID_RE = "^[A-Za-z0-9\\-_]+$"


def valid_id(c: str) -> str:
    return f"regexp_full_match(CAST({c} AS VARCHAR), '{ID_RE}')"


def patients_suite() -> str:
    s, t = "patients", "bronze_patients"
    dob = lts("date_of_birth")
    age = f"(floor((epoch({ADM_AS_OF}) - epoch({dob})) / 86400) / 365.25)"
    parts = [
        empty(s, t, "Table is empty"),
        static(s, 0, "Missing required columns: []"),
        row_check(s, t, "pk_null", "issue", "patient_id IS NULL", "%d null values in primary key patient_id"),
        row_check(s, t, "id_format", "issue", f"NOT {valid_id('patient_id')}", "%d patient IDs with invalid format"),
        row_check(s, t, "dob_invalid", "issue", f"{dob} IS NULL", "%d invalid date formats in date_of_birth"),
        row_check(s, t, "dob_future_far", "issue", f"{dob} > {ts('2002-08-01')}", "%d patients with birth dates >1 years in future"),
        row_check(s, t, "dob_future_near", "warning", f"{dob} > {ADM_AS_OF} AND {dob} <= {ts('2002-08-01')}",
                  "%d patients with future birth dates (within 1 years)"),
        row_check(s, t, "dob_very_old", "warning", f"{dob} < {ts('1881-08-01')}", "%d patients older than 120 years"),
        row_check(s, t, "age_too_young", "warning", f"{age} < 0", "%d patients with age < 0"),
        row_check(s, t, "age_too_old", "warning", f"{age} > 120", "%d patients with age > 120"),
    ]
    for c in ("first_name", "last_name"):
        parts += [
            row_check(s, t, f"{c}_empty", "warning", blank(c), f"%d empty {c} values"),
            row_check(s, t, f"{c}_unusual", "warning", f"coalesce(regexp_matches({c}, '[0-9@#$%^&*]'), false)",
                      f"%d {c} values with unusual characters"),
        ]
    parts.append(surplus(s, t, "patient_id", "%d duplicate values in primary key patient_id"))
    return union(parts)


def admissions_suite() -> str:
    s, t = "admissions", "bronze_admissions"
    d = lts("admission_date")
    return union([
        empty(s, t, "Table is empty"),
        static(s, 0, "Missing required columns: []"),
        row_check(s, t, "pk_null", "issue", "admission_id IS NULL", "%d null values in primary key admission_id"),
        row_check(s, t, "patient_null", "issue", "patient_id IS NULL", "%d admissions missing patient_id"),
        row_check(s, t, "date_invalid", "issue", f"{d} IS NULL", "%d invalid admission dates"),
        row_check(s, t, "date_future", "warning", f"{d} > {ADM_AS_OF}", "%d future admission dates"),
        row_check(s, t, "date_old", "warning", f"{d} < {ts('1999-08-01')}", "%d admissions older than 2 years"),
        surplus(s, t, "admission_id", "%d duplicate values in primary key admission_id"),
    ])


def discharges_suite() -> str:
    s, t = "discharges", "bronze_discharges"
    return union([
        empty(s, t, "Table is empty"),
        static(s, 0, "Missing required columns: []"),
        row_check(s, t, "pk_null", "issue", "discharge_id IS NULL", "%d null values in primary key discharge_id"),
        row_check(s, t, "date_invalid", "issue", f"{lts('discharge_date')} IS NULL", "%d invalid discharge dates"),
        surplus(s, t, "discharge_id", "%d duplicate values in primary key discharge_id"),
    ])


def wards_suite() -> str:
    s, t = "wards", "bronze_wards"
    cap = ldouble("capacity")
    return union([
        empty(s, t, "Table is empty"),
        static(s, 0, "Missing required columns: []"),
        row_check(s, t, "pk_null", "issue", "ward_id IS NULL", "%d null values in primary key ward_id"),
        row_check(s, t, "capacity_negative", "issue", f"{cap} < 0", "%d wards with negative capacity"),
        row_check(s, t, "capacity_unrealistic", "issue", f"{cap} < 1 OR {cap} > 200", "%d wards with unrealistic capacity"),
        surplus(s, t, "ward_id", "%d duplicate values in primary key ward_id"),
    ])


KNOWN = "('antibiotic', 'analgesic', 'antiviral', 'antifungal', 'vaccine', 'insulin', 'chemotherapy', 'anesthetic')"


def pharmacy_suite() -> str:
    s, t = "pharmacy", "bronze_pharmacy"
    q, e = ldouble("quantity"), lts("expiry_date")
    unknown = f"(SELECT DISTINCT category AS v FROM {t} WHERE category IS NOT NULL AND category NOT IN {KNOWN})"
    unk_val = (f"SELECT CAST((SELECT count(*) FROM {unknown}) AS BIGINT) AS failed, "
               f"(SELECT string_agg(v, ''', ''' ORDER BY v) FROM (SELECT v FROM {unknown} ORDER BY v LIMIT 5)) AS s")
    return union([
        empty(s, t, "Drug inventory data is empty"),
        static(s, 0, "Missing required columns: []"),
        row_check(s, t, "null_drug_id", "issue", "drug_id IS NULL", "Found %d null drug IDs"),
        row_check(s, t, "null_drug_name", "issue", "drug_name IS NULL", "Found %d null drug names"),
        row_check(s, t, "empty_drug_name", "warning", blank("drug_name"), "Found %d empty drug names"),
        row_check(s, t, "short_drug_name", "warning", "length(drug_name) < 2", "Found %d very short drug names (< 2 chars)"),
        row_check(s, t, "numeric_drug_name", "warning", "coalesce(regexp_full_match(drug_name, '^\\d+$'), false)",
                  "Found %d drug names that are only numbers"),
        row_check(s, t, "quantity_negative", "issue", f"{q} < 0", "Found %d drugs with negative quantity"),
        row_check(s, t, "quantity_high", "warning", f"{q} > 1000", "Found %d drugs with unusually high quantity (> 1000)"),
        row_check(s, t, "quantity_over_max", "issue", f"{q} > 10000", "Found %d drugs exceeding maximum quantity (10000)"),
        row_check(s, t, "quantity_zero", "warning", f"{q} = 0", "Found %d drugs with zero quantity (may be out of stock)"),
        row_check(s, t, "quantity_non_numeric", "issue", f"{q} IS NULL", "Found %d drugs with non-numeric quantity values"),
        row_check(s, t, "expiry_invalid", "issue", f"{e} IS NULL", "Found %d drugs with invalid expiry date format"),
        row_check(s, t, "expired", "issue", f"{e} < {LAB_AS_OF}", "Found %d expired drugs (tolerance: 0)"),
        row_check(s, t, "expiring_soon", "warning", f"{e} >= {LAB_AS_OF} AND {e} <= {ts('2024-03-02')}",
                  "Found %d drugs expiring within 30 days"),
        row_check(s, t, "expiry_far_future", "warning", f"{e} > {ts('2029-01-30')}", "Found %d drugs with expiry dates >5 years in future"),
        row_check(s, t, "expiry_before_2000", "issue", f"{e} < {ts('2000-01-01')}", "Found %d drugs with expiry dates before 2000"),
        row_check(s, t, "category_missing", "warning", blank("category"), "Found %d drugs without category"),
        surplus(s, t, "drug_id", "Found %d duplicate drug IDs"),
        metric(s, "category_unknown", "warning", unk_val, "'Found unknown drug categories: [''' || s || ''']'"),
    ])


def labs_suite() -> str:
    s, t = "lab_results", "bronze_lab_results"
    d, x = lts("test_date"), ldouble("result_value")
    pos = "coalesce(regexp_matches(lower(trim(test_type)), 'glucose|cholesterol|hemoglobin|wbc|rbc|platelets'), false)"
    nonnum = f"(SELECT * FROM {t} WHERE {x} IS NULL AND result_value IS NOT NULL)"
    nn_val = (f"SELECT CAST((SELECT count(*) FROM {nonnum}) AS BIGINT) AS failed, "
              f"(SELECT string_agg(v, ''', ''' ORDER BY v) FROM (SELECT DISTINCT test_type AS v FROM {nonnum} "
              f"WHERE test_type IS NOT NULL ORDER BY v LIMIT 5)) AS s")
    rare_val = (f"SELECT CAST(count(*) AS BIGINT) AS failed FROM (SELECT test_type FROM {t} WHERE test_type IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) < greatest(1.0, (SELECT count(*) FROM {t}) * 0.001))")
    same_val = (f"SELECT CAST(count(*) AS BIGINT) AS failed FROM (SELECT patient_id, {d} AS tt FROM {t} "
                f"WHERE patient_id IS NOT NULL AND {d} IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)")
    intervals = (f"SELECT CAST(floor((epoch_us(tt) - epoch_us(lag(tt) OVER (PARTITION BY patient_id ORDER BY tt))) "
                 f"/ 86400000000.0) AS BIGINT) AS days FROM (SELECT patient_id, {d} AS tt FROM {t}) "
                 f"WHERE tt IS NOT NULL AND patient_id IS NOT NULL")
    freq_val = f"SELECT CAST(count_if(days < 1) AS BIGINT) AS failed FROM ({intervals})"
    classes = f"""(SELECT range_name, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS std,
        count_if(x < {bound_sql('range_name', 1)}) + count_if(x > {bound_sql('range_name', 2)}) AS ab
   FROM (SELECT {classify_sql('test_type')} AS range_name, {x} AS x FROM {t}) WHERE x IS NOT NULL AND range_name IS NOT NULL
   GROUP BY 1)"""
    abnormal = f"""SELECT '{s}' AS suite, 'abnormal_' || range_name AS "check",
       CASE WHEN CAST(ab AS DOUBLE) / n > 0.5 THEN 'issue' ELSE 'warning' END AS severity,
       CAST(ab AS BIGINT) AS failed, ab > 0 AS fired,
       CASE WHEN ab > 0 THEN printf('%s: %d abnormal results (%.1f%%)', range_name, CAST(ab AS BIGINT), CAST(ab AS DOUBLE) / n * 100) END AS message
FROM {classes}"""
    outliers = f"""SELECT '{s}' AS suite, 'outliers_' || c.range_name AS "check", 'warning' AS severity,
       CAST(count_if(c.n > 10 AND c.std > 0 AND abs(r.x - c.mean) > 4 * c.std) AS BIGINT) AS failed,
       count_if(c.n > 10 AND c.std > 0 AND abs(r.x - c.mean) > 4 * c.std) > 0 AS fired,
       CASE WHEN count_if(c.n > 10 AND c.std > 0 AND abs(r.x - c.mean) > 4 * c.std) > 0
            THEN printf('%s: %d extreme outliers', c.range_name,
                        CAST(count_if(c.n > 10 AND c.std > 0 AND abs(r.x - c.mean) > 4 * c.std) AS BIGINT)) END AS message
FROM (SELECT {classify_sql('test_type')} AS range_name, {x} AS x FROM {t}) r JOIN {classes} c ON r.range_name = c.range_name
WHERE r.x IS NOT NULL GROUP BY c.range_name"""
    return union([
        empty(s, t, "Lab results data is empty"),
        static(s, 0, "Missing required columns: []"),
        row_check(s, t, "patient_null", "issue", "patient_id IS NULL", "Found %d tests without patient ID"),
        row_check(s, t, "patient_format", "warning", f"NOT {valid_id('patient_id')}", "Found %d tests with unusual patient ID format"),
        row_check(s, t, "patient_length", "warning", "length(patient_id) < 3 OR length(patient_id) > 20",
                  "Found %d tests with unusual patient ID length"),
        row_check(s, t, "test_type_null", "issue", "test_type IS NULL", "Found %d tests without test type"),
        row_check(s, t, "test_type_empty", "issue", "trim(test_type) = ''", "Found %d tests with empty test type"),
        row_check(s, t, "date_invalid", "issue", f"{d} IS NULL", "Found %d tests with invalid date format"),
        row_check(s, t, "date_future_far", "issue", f"{d} > {ts('2024-02-08')}", "Found %d tests with dates >7 days in future"),
        row_check(s, t, "date_future_near", "warning", f"{d} > {LAB_AS_OF} AND {d} <= {ts('2024-02-08')}",
                  "Found %d tests with dates up to 7 days in future"),
        row_check(s, t, "date_old", "warning", f"{d} < {ts('2014-02-01')}", "Found %d tests older than 10 years"),
        row_check(s, t, "result_null", "warning", "result_value IS NULL", "Found %d tests with null results"),
        row_check(s, t, "result_negative", "issue", f"{x} IS NOT NULL AND {pos} AND {x} < 0",
                  "Found %d tests with negative values (should be positive)"),
        metric(s, "result_non_numeric", "warning", nn_val,
               "'Found ' || CAST(failed AS VARCHAR) || ' non-numeric results for test types: [''' || s || ''']'"),
        metric(s, "test_type_rare", "warning", rare_val, "printf('Found %d very rare test types (potential typos)', failed)"),
        metric(s, "same_time_tests", "warning", same_val, "printf('Found %d patient-date combinations with multiple tests', failed)"),
        metric(s, "frequent_tests", "warning", freq_val, "printf('Found %d tests with <1 day interval', failed)"),
        abnormal,
        outliers,
    ])


ORACLE["vs_01_patients"] = with_views(["bronze_patients"], patients_suite())
ORACLE["vs_02_admissions"] = with_views(["bronze_admissions"], admissions_suite())
ORACLE["vs_03_discharges"] = with_views(["bronze_discharges"], discharges_suite())
ORACLE["vs_04_wards"] = with_views(["bronze_wards"], wards_suite())
ORACLE["vs_06_pharmacy"] = with_views(["bronze_pharmacy"], pharmacy_suite())
ORACLE["vs_08_labs"] = with_views(["bronze_lab_results"], labs_suite())


def silver_suites() -> str:
    return union([
        rowcount("silver_patients", "silver_patients_dirty"),
        rowcount("silver_admissions", "silver_admissions_dirty"),
        rowcount("silver_pharmacy_inventory", "silver_pharmacy_dirty"),
        rowcount("silver_lab_results", "silver_labs_dirty"),
        row_check("silver_patients", "silver_patients_dirty", "null_patient_id", "issue", "patient_id IS NULL", "%d null patient_ids"),
        row_check("silver_patients", "silver_patients_dirty", "future_birth", "issue", "date_of_birth > DATE '2001-08-01'", "%d future birth dates"),
        metric("silver_patients", "duplicate_patient_id", "issue",
               "SELECT CAST(count(*) AS BIGINT) AS failed FROM (SELECT patient_id FROM silver_patients_dirty GROUP BY 1 HAVING count(*) > 1)",
               "printf('%d duplicate patient_ids', failed)"),
        row_check("silver_admissions", "silver_admissions_dirty", "null_admission_id", "issue", "admission_id IS NULL", "%d null admission_ids"),
        row_check("silver_admissions", "silver_admissions_dirty", "future_admission", "warning", f"admission_time > {ADM_AS_OF}",
                  "%d future admission dates (scheduled?)"),
        row_check("silver_pharmacy_inventory", "silver_pharmacy_dirty", "negative_stock", "issue", "stock_on_hand < 0", "%d negative stock values"),
        row_check("silver_pharmacy_inventory", "silver_pharmacy_dirty", "expired", "issue", "expiry_date < DATE '2024-02-01'", "%d expired drugs"),
        row_check("silver_lab_results", "silver_labs_dirty", "null_test_type", "issue", "test_type IS NULL", "%d null test types"),
        row_check("silver_lab_results", "silver_labs_dirty", "future_test", "issue", f"sample_datetime > {LAB_AS_OF}", "%d future test dates"),
    ])


ORACLE["vs_11_14_silver"] = with_views(
    ["silver_patients_dirty", "silver_admissions_dirty", "silver_pharmacy_dirty", "silver_labs_dirty"], silver_suites()
)

_GOLD_CTES = f"""g_dim_patient AS (SELECT patient_id AS patient_key, patient_id,
       CASE WHEN date_of_birth IS NOT NULL THEN 2001 - year(date_of_birth) END AS age FROM silver_patients_dirty),
g_fact_adm AS {_DIRTY_FACT_ADM},
g_fact_pharm AS (SELECT drug_name, CAST(coalesce(current_stock, 0) AS INTEGER) AS stock_on_hand,
       CAST(coalesce(threshold, 10) AS INTEGER) AS reorder_level FROM silver_pharmacy_dirty),
g_summary AS (SELECT p.patient_id, p.age, coalesce(c.n, 0) AS total_admissions FROM g_dim_patient p
       LEFT JOIN (SELECT patient_id, count(*) AS n FROM g_fact_adm GROUP BY 1) c ON p.patient_id = c.patient_id),
g_daily AS (SELECT strftime(admission_time, '%Y-%m-%d') AS d, count(*) AS daily_admissions,
       count(DISTINCT patient_id) AS unique_patients FROM g_fact_adm GROUP BY 1)"""


def gold_suites() -> str:
    uniq = ("SELECT CAST(count(*) - (count(DISTINCT patient_key) + coalesce(max(CASE WHEN patient_key IS NULL THEN 1 ELSE 0 END), 0)) AS BIGINT) "
            "AS failed, count(*) AS total, count(DISTINCT patient_key) + coalesce(max(CASE WHEN patient_key IS NULL THEN 1 ELSE 0 END), 0) AS uniq "
            "FROM g_dim_patient")
    return union([
        rowcount("gold_dim_patient", "g_dim_patient"),
        rowcount("gold_fact_admissions", "g_fact_adm"),
        rowcount("gold_fact_pharmacy", "g_fact_pharm"),
        rowcount("gold_patient_summary", "g_summary"),
        rowcount("gold_daily_admissions_summary", "g_daily"),
        row_check("gold_dim_patient", "g_dim_patient", "null_key", "issue", "patient_key IS NULL", "%d null values in dimension key"),
        metric("gold_dim_patient", "duplicate_key", "issue",
               "SELECT CAST(count(*) AS BIGINT) AS failed FROM (SELECT patient_key FROM g_dim_patient GROUP BY 1 HAVING count(*) > 1)",
               "printf('%d duplicate patient keys', failed)"),
        metric("gold_dim_patient", "key_uniqueness", "issue", uniq,
               "printf('Dimension keys not unique: %d rows, %d unique keys', total, uniq)"),
        row_check("gold_fact_admissions", "g_fact_adm", "null_patient_id", "issue", "patient_id IS NULL", "%d null patient_ids in fact table"),
        row_check("gold_fact_admissions", "g_fact_adm", "null_admission_id", "issue", "admission_id IS NULL", "%d null admission_ids"),
        row_check("gold_fact_pharmacy", "g_fact_pharm", "negative_stock", "issue", "stock_on_hand < 0", "%d negative stock values"),
        row_check("gold_fact_pharmacy", "g_fact_pharm", "needs_reorder", "metric", "stock_on_hand < reorder_level", "%d items need reorder",
                  tol=2**62),
        row_check("gold_patient_summary", "g_summary", "negative_admissions", "issue", "total_admissions < 0", "%d negative admission counts"),
        row_check("gold_patient_summary", "g_summary", "invalid_age", "issue", "age < 0 OR age > 120", "%d invalid age values"),
        row_check("gold_daily_admissions_summary", "g_daily", "negative_daily", "issue", "daily_admissions < 0", "%d negative daily admissions"),
        row_check("gold_daily_admissions_summary", "g_daily", "illogical_unique", "issue", "unique_patients > daily_admissions",
                  "%d rows where unique_patients > daily_admissions"),
    ])


ORACLE["vs_15_17_gold"] = with_views(
    ["silver_patients_dirty", "silver_admissions_dirty", "silver_pharmacy_dirty"],
    f", {_GOLD_CTES}\n" + gold_suites(),
).replace("\n, g_dim_patient", ",\ng_dim_patient", 1)


def _results_sql() -> str:
    rows = """rc AS (SELECT 'patients' AS t, count(*) AS n FROM bronze_patients UNION ALL SELECT 'admissions', count(*) FROM bronze_admissions
  UNION ALL SELECT 'pharmacy', count(*) FROM bronze_pharmacy UNION ALL SELECT 'lab_results', count(*) FROM bronze_lab_results)"""
    checks = f"""ck AS ({patients_suite()}
UNION ALL {admissions_suite()}
UNION ALL {pharmacy_suite()}
UNION ALL {labs_suite()})"""
    agg = """a AS (SELECT rc.t, rc.n,
    coalesce(sum(CASE WHEN ck.fired AND ck.severity = 'issue' THEN 1 ELSE 0 END), 0) AS i,
    coalesce(sum(CASE WHEN ck.fired AND ck.severity = 'warning' THEN 1 ELSE 0 END), 0) AS w,
    coalesce(sum(CASE WHEN ck."check" = 'expired' THEN ck.failed ELSE 0 END), 0) AS expired
  FROM rc LEFT JOIN ck ON ck.suite = rc.t GROUP BY rc.t, rc.n)"""
    final = """r AS (SELECT t AS table_name, CAST(n AS BIGINT) AS row_count,
    CAST(i + CASE WHEN t IN ('patients', 'admissions') AND n > 0 AND i / n > 0.05 THEN 1 ELSE 0 END AS INTEGER) AS issue_count,
    CAST(w AS INTEGER) AS warning_count,
    CASE WHEN t IN ('patients', 'admissions') THEN i = 0
         WHEN t = 'pharmacy' THEN i = 0 OR NOT (i / greatest(n, 1) > 0.01 OR expired / greatest(n, 1) > 0)
         ELSE i = 0 OR NOT (i / greatest(n, 1) > 0.05) END AS passed
  FROM a)"""
    return ",\n".join([rows, checks, agg, final])


_SUITE_VIEWS = ["bronze_patients", "bronze_admissions", "bronze_pharmacy", "bronze_lab_results"]

ORACLE["vs_09_suite_results"] = with_views(
    _SUITE_VIEWS,
    ", " + _results_sql() + """
SELECT table_name, row_count, issue_count, warning_count, passed,
       CAST(CASE WHEN row_count = 0 THEN 0.0 ELSE greatest(0.0, least(100.0,
            100.0 - least(50.0, issue_count * 10.0) - least(20.0, warning_count * 2.0))) END AS DOUBLE) AS quality_score
FROM r""",
)

ORACLE["vs_19_rollup"] = with_views(
    _SUITE_VIEWS,
    ", " + _results_sql() + """
SELECT coalesce(min(CAST(passed AS INTEGER)) = 1, true) AS all_passed,
       coalesce(string_agg(CASE WHEN NOT passed THEN table_name END, ',' ORDER BY table_name), '') AS failed_tables,
       CAST(count(*) AS BIGINT) AS tables_checked FROM r""",
)

# ---------------------------------------------------------------- sources and sinks (round trips)

ORACLE["src_04_snapshot_scan"] = ORACLE["tb_03_silver_patients"]
ORACLE["src_05_multi_csv"] = with_views(
    ["silver_labs_dirty"],
    """SELECT lab_result_id, patient_id, test_type, test_date, result_value, collected_time, completed_time,
       sample_datetime, completed_datetime, turnaround_hours, silver_load_timestamp, true AS has_source
FROM silver_labs_dirty""",
)
ORACLE["src_07_nested_json"] = ORACLE["tb_02_silver_pharmacy"]
ORACLE["snk_04_results_json"] = ORACLE["vs_09_suite_results"] + "\nWHERE table_name = 'pharmacy'"
ORACLE["snk_07_publish_twice"] = ORACLE["tb_13_fact_pharmacy"]
ORACLE["snk_03_fallback"] = ORACLE["tb_13_fact_pharmacy"]
ORACLE["vs_20_guarded"] = f"""SELECT * FROM ({ORACLE["snk_04_results_json"]})
UNION ALL SELECT 'broken', CAST(0 AS BIGINT), CAST(1 AS INTEGER), CAST(0 AS INTEGER), false, CAST(0 AS DOUBLE)"""
ORACLE["snk_06_named_objects"] = with_views(
    ["fact_admissions", "fact_lab_turnaround", "fact_pharmacy", "fact_icu_alerts", "dim_ward", "dim_patient", "pharmacy_inventory"],
    """SELECT 'table' AS kind, 'dim_patient' AS object, count(*) AS rows FROM dim_patient
UNION ALL SELECT 'table', 'dim_ward', count(*) FROM dim_ward
UNION ALL SELECT 'table', 'dim_date', 2922
UNION ALL SELECT 'table', 'dim_drug', count(*) FROM (SELECT DISTINCT drug_name FROM pharmacy_inventory)
UNION ALL SELECT 'table', 'fact_admissions', count(*) FROM fact_admissions
UNION ALL SELECT 'table', 'fact_lab_turnaround', count(*) FROM fact_lab_turnaround
UNION ALL SELECT 'table', 'fact_pharmacy', count(*) FROM fact_pharmacy
UNION ALL SELECT 'table', 'fact_icu_alerts', count(*) FROM fact_icu_alerts
UNION ALL SELECT 'view', 'kpi_daily_admissions_by_ward', count(*) FROM (SELECT DISTINCT CAST(admission_time AS DATE), ward_id FROM fact_admissions)
UNION ALL SELECT 'view', 'kpi_daily_lab_turnaround', count(*) FROM (SELECT DISTINCT CAST(sample_time AS DATE) FROM fact_lab_turnaround)
UNION ALL SELECT 'view', 'kpi_low_stock', 1
UNION ALL SELECT 'view', 'kpi_daily_icu_alerts', count(*) FROM (SELECT DISTINCT CAST(alert_time AS DATE), alert_type, severity FROM fact_icu_alerts)""",
)
ORACLE["snk_08_table_builds"] = with_views(
    ["wards", "patients", "fact_admissions"],
    """SELECT 'dim_ward' AS "table", CAST(count(*) AS BIGINT) AS rows, 'ok' AS status FROM wards
UNION ALL SELECT 'dim_patient', CAST(count(*) AS BIGINT), 'ok' FROM patients
UNION ALL SELECT 'fact_admissions', CAST(count(*) AS BIGINT), 'ok' FROM fact_admissions
UNION ALL SELECT 'dim_drug', CAST(NULL AS BIGINT), 'skipped'
UNION ALL SELECT 'fact_labs', CAST(NULL AS BIGINT), 'failed'""",
)
ORACLE["snk_05_external_tables"] = ORACLE["agg_04_daily_admissions_by_ward"]
from . import oracle_doc  # noqa: E402,F401
