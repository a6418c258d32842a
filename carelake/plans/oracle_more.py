"""Oracle statements for gold tables, silver conditioning and joins."""

from __future__ import annotations

from .oracle_sql import ADM_AS_OF, DEPENDS, LAB_AS_OF, ORACLE, VIEWS, skey, ts_text, with_views

GENDER_CASE = """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'F' WHEN 'FURNITURE' THEN 'F' WHEN 'MACHINERY' THEN 'M'
            WHEN 'BUILDING' THEN 'M' WHEN 'AUTOMOBILE' THEN 'O' END"""
TEST_CASE = """CASE event_type WHEN 'click' THEN 'Glucose' WHEN 'view' THEN 'Hemoglobin' WHEN 'purchase' THEN 'Sodium'
            WHEN 'error' THEN 'ALT' WHEN 'signup' THEN 'Renal Panel' END"""
ISO_TS = "'%Y-%m-%d %H:%M:%S'"


def ldouble(e: str) -> str:
    """SQL twin of ``lenient_double``."""
    v = f"TRY_CAST(trim(CAST({e} AS VARCHAR)) AS DOUBLE)"
    return f"(CASE WHEN isnan({v}) THEN NULL ELSE {v} END)"


def llong(e: str) -> str:
    """Digits as they stand; a decimal form is truncated, never rounded through double."""
    s = f"trim(CAST({e} AS VARCHAR))"
    return f"(CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+') THEN TRY_CAST({s} AS BIGINT) ELSE TRY_CAST(trunc(TRY_CAST({s} AS DECIMAL(38, 10))) AS BIGINT) END)"


def lid(e: str) -> str:
    """An identifier as text: digits of numeric forms, else the trimmed text, blank as NULL."""
    return f"coalesce(CAST({llong(e)} AS VARCHAR), nullif(trim(CAST({e} AS VARCHAR)), ''))"


def lint(e: str) -> str:
    return f"TRY_CAST({llong(e)} AS INTEGER)"


def lts(e: str) -> str:
    """ISO text and four other forms; eight digits are a date, not a year."""
    s = f"trim(CAST({e} AS VARCHAR))"
    forms = "['%Y/%m/%d', '%Y/%m/%d %H:%M:%S', '%d %b %Y', '%Y%m%d']"
    return f"(CASE WHEN regexp_full_match({s}, '[0-9]{{8}}') THEN try_strptime({s}, '%Y%m%d') ELSE coalesce(TRY_CAST({s} AS TIMESTAMP), try_strptime({s}, {forms})) END)"


def ldate(e: str) -> str:
    return f"CAST({lts(e)} AS DATE)"


_BRONZE_PATIENT_BASE = f"""
SELECT CASE WHEN c_custkey % 101 = 7 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS patient_id,
       CASE WHEN c_custkey % 97 = 5 THEN ' ' ELSE split_part(c_name, '#', 1) END AS first_name,
       CASE WHEN c_custkey % 89 = 3 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
       CASE WHEN c_custkey % 83 = 2 THEN 'not-a-date'
            WHEN c_custkey % 113 = 5 THEN strftime(DATE '1930-01-01' + CAST((c_custkey * 37) % 36500 AS INTEGER), '%Y/%m/%d')
            WHEN c_custkey % 131 = 7 THEN strftime(DATE '1930-01-01' + CAST((c_custkey * 37) % 36500 AS INTEGER), '%Y%m%d')
            ELSE strftime(DATE '1930-01-01' + CAST((c_custkey * 37) % 36500 AS INTEGER), '%Y-%m-%d') END AS date_of_birth,
       {GENDER_CASE} AS gender, '2001-07-01' AS dt, c_custkey AS _k
FROM customer"""

VIEWS["bronze_patients"] = f"""
SELECT patient_id, first_name, last_name, date_of_birth, gender, dt FROM ({_BRONZE_PATIENT_BASE})
UNION ALL
SELECT patient_id, first_name, coalesce(last_name, '') || '-v2', date_of_birth, gender, '2001-08-01'
FROM ({_BRONZE_PATIENT_BASE}) WHERE _k % 50 = 0"""

_BRONZE_ADM_BASE = f"""
SELECT CASE WHEN admission_id % 107 = 9 THEN NULL ELSE CAST(admission_id AS VARCHAR) END AS admission_id,
       CASE WHEN admission_id % 101 = 1 THEN NULL ELSE CAST(patient_id AS VARCHAR) END AS patient_id,
       CASE WHEN admission_id % 83 = 4 THEN 'n/a' WHEN admission_id % 113 = 5 THEN strftime(admission_time, '%Y/%m/%d %H:%M:%S')
            WHEN admission_id % 127 = 6 THEN strftime(admission_time, '%d %b %Y') ELSE strftime(admission_time, {ISO_TS}) END AS admission_date,
       CAST(ward_id AS VARCHAR) AS ward_id, '2001-08-01' AS dt, admission_id AS _k
FROM admissions"""

VIEWS["bronze_admissions"] = f"""
SELECT admission_id, patient_id, admission_date, ward_id, dt FROM ({_BRONZE_ADM_BASE})
UNION ALL
SELECT admission_id, patient_id, admission_date, ward_id, dt FROM ({_BRONZE_ADM_BASE}) WHERE _k % 50 = 0"""

VIEWS["bronze_lab_results"] = f"""
SELECT CASE WHEN event_id % 103 = 7 THEN CAST(event_id + 9007199254740993 AS VARCHAR)
            WHEN event_id % 109 = 8 THEN CAST(event_id AS VARCHAR) || '.0' ELSE CAST(event_id AS VARCHAR) END AS lab_result_id,
       CASE WHEN event_id % 101 = 3 THEN NULL WHEN event_id % 97 = 1 THEN 'P#' || CAST(user_id AS VARCHAR)
            ELSE CAST(user_id AS VARCHAR) END AS patient_id,
       CASE WHEN event_id % 89 = 2 THEN NULL WHEN event_id % 83 = 5 THEN '  ' ELSE {TEST_CASE} END AS test_type,
       CASE WHEN event_id % 79 = 4 THEN 'tbd' WHEN event_id % 71 = 1 THEN '2024-02-05 10:00:00'
            WHEN event_id % 67 = 2 THEN '2024-03-15 10:00:00' WHEN event_id % 113 = 5 THEN strftime(ts, '%Y/%m/%d')
            WHEN event_id % 127 = 6 THEN strftime(ts, '%d %b %Y') WHEN event_id % 131 = 7 THEN strftime(ts, '%Y%m%d')
            ELSE strftime(ts, {ISO_TS}) END AS test_date,
       CASE WHEN event_id % 61 = 3 THEN 'positive' WHEN event_id % 59 = 4 THEN NULL
            WHEN event_id % 53 = 5 AND event_type = 'click' THEN '-' || CAST(value AS VARCHAR)
            ELSE CAST(value AS VARCHAR) END AS result_value,
       strftime(ts, {ISO_TS}) AS collected_time,
       strftime(ts + to_seconds(CAST(floor(value * 60) AS BIGINT)), {ISO_TS}) AS completed_time
FROM events"""

_BRONZE_PHARM_BASE = """
SELECT CASE WHEN p_partkey % 109 = 8 THEN ' D-' || CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS drug_id,
       CASE WHEN p_partkey % 101 = 1 THEN NULL WHEN p_partkey % 97 = 2 THEN '' WHEN p_partkey % 89 = 3 THEN 'X'
            WHEN p_partkey % 83 = 4 THEN '12345' ELSE p_name END AS drug_name,
       CASE WHEN p_partkey % 79 = 5 THEN 'n/a' WHEN p_partkey % 73 = 6 THEN '-1' WHEN p_partkey % 71 = 0 THEN '0'
            WHEN p_partkey % 67 = 1 THEN '1500' WHEN p_partkey % 61 = 2 THEN '20000'
            ELSE CAST(p_size AS VARCHAR) END AS quantity,
       CASE WHEN p_partkey % 59 = 3 THEN 'bad' WHEN p_partkey % 53 = 4 THEN '1999-05-01'
            WHEN p_partkey % 47 = 5 THEN '2031-01-01'
            WHEN p_partkey % 113 = 5 THEN strftime(DATE '2024-02-01' + CAST(p_partkey % 800 - 100 AS INTEGER), '%d %b %Y')
            ELSE strftime(DATE '2024-02-01' + CAST(p_partkey % 800 - 100 AS INTEGER), '%Y-%m-%d') END AS expiry_date,
       CASE WHEN p_partkey % 43 = 6 THEN NULL WHEN p_partkey % 41 = 0 THEN 'antibiotic' ELSE p_type END AS category,
       p_brand AS supplier, CAST(p_size AS VARCHAR) AS stock_on_hand, CAST(p_partkey % 20 AS VARCHAR) AS reorder_level,
       p_partkey AS _k
FROM part"""

VIEWS["bronze_pharmacy"] = f"""
SELECT * EXCLUDE (_k) FROM ({_BRONZE_PHARM_BASE})
UNION ALL
SELECT * EXCLUDE (_k) FROM ({_BRONZE_PHARM_BASE}) WHERE _k % 50 = 0"""

VIEWS["bronze_wards"] = """
SELECT CAST(ward_id AS VARCHAR) AS ward_id, ward_name, CAST(capacity AS VARCHAR) AS capacity, '2001-08-01' AS dt FROM wards"""

VIEWS["bronze_discharges"] = f"""
SELECT CAST(discharge_id AS VARCHAR) AS discharge_id, CAST(admission_id AS VARCHAR) AS admission_id,
       CAST(patient_id AS VARCHAR) AS patient_id,
       CASE WHEN discharge_id % 97 = 3 THEN '??' ELSE strftime(discharge_time, {ISO_TS}) END AS discharge_date,
       '2001-08-01' AS dt
FROM discharges"""

# ---- silver (conditioning of the bronze views)

VIEWS["silver_labs_dirty"] = f"""
SELECT {lid('lab_result_id')} AS lab_result_id, {lid('patient_id')} AS patient_id, test_type,
       CAST({lts('collected_time')} AS DATE) AS test_date, result_value, {lts('collected_time')} AS collected_time, {lts('completed_time')} AS completed_time,
       {lts('collected_time')} AS sample_datetime, {lts('completed_time')} AS completed_datetime,
       (floor(epoch({lts('completed_time')})) - floor(epoch({lts('collected_time')}))) / 3600.0 AS turnaround_hours,
       {LAB_AS_OF} AS silver_load_timestamp
FROM bronze_lab_results"""

VIEWS["silver_pharmacy_dirty"] = f"""
SELECT {lid('drug_id')} AS drug_id, drug_name, quantity, {ldate('expiry_date')} AS expiry_date, category, supplier,
       {lint('stock_on_hand')} AS stock_on_hand, {lint('reorder_level')} AS reorder_level,
       {lint('stock_on_hand')} AS current_stock, {lint('reorder_level')} AS threshold,
       {LAB_AS_OF} AS silver_load_timestamp
FROM bronze_pharmacy"""

VIEWS["silver_patients_dirty"] = f"""
SELECT patient_id, first_name, last_name, gender, dt, date_of_birth, {ADM_AS_OF} AS silver_load_timestamp
FROM (SELECT {llong('patient_id')} AS patient_id, first_name, last_name, gender, dt, {ldate('date_of_birth')} AS date_of_birth
      FROM bronze_patients)
QUALIFY patient_id IS NULL OR row_number() OVER (PARTITION BY patient_id ORDER BY dt DESC NULLS LAST, first_name DESC NULLS LAST,
        last_name DESC NULLS LAST, gender DESC NULLS LAST, date_of_birth DESC NULLS LAST) = 1"""

VIEWS["silver_admissions_dirty"] = f"""
SELECT admission_id, patient_id, ward_id, dt, admission_time, {ADM_AS_OF} AS silver_load_timestamp
FROM (SELECT {llong('admission_id')} AS admission_id, {llong('patient_id')} AS patient_id, {llong('ward_id')} AS ward_id,
             dt, {lts('admission_date')} AS admission_time FROM bronze_admissions)
QUALIFY admission_id IS NULL OR row_number() OVER (PARTITION BY admission_id ORDER BY dt DESC NULLS LAST, patient_id DESC NULLS LAST,
        ward_id DESC NULLS LAST, admission_time DESC NULLS LAST) = 1"""

VIEWS["silver_discharges_dirty"] = f"""
SELECT discharge_id, admission_id, patient_id, dt, discharge_time, {ADM_AS_OF} AS silver_load_timestamp
FROM (SELECT {llong('discharge_id')} AS discharge_id, {llong('admission_id')} AS admission_id,
             {llong('patient_id')} AS patient_id, dt, {lts('discharge_date')} AS discharge_time FROM bronze_discharges)
QUALIFY discharge_id IS NULL OR row_number() OVER (PARTITION BY discharge_id ORDER BY dt DESC NULLS LAST, admission_id DESC NULLS LAST,
        patient_id DESC NULLS LAST, discharge_time DESC NULLS LAST) = 1"""

VIEWS["silver_wards_dirty"] = f"""
SELECT {llong('ward_id')} AS ward_id, ward_name, {lint('capacity')} AS capacity, dt, {ADM_AS_OF} AS silver_load_timestamp
FROM bronze_wards"""

DEPENDS.update(
    {
        "bronze_admissions": ["admissions"],
        "bronze_wards": ["wards"],
        "bronze_discharges": ["discharges"],
        "silver_labs_dirty": ["bronze_lab_results"],
        "silver_pharmacy_dirty": ["bronze_pharmacy"],
        "silver_patients_dirty": ["bronze_patients"],
        "silver_admissions_dirty": ["bronze_admissions"],
        "silver_discharges_dirty": ["bronze_discharges"],
        "silver_wards_dirty": ["bronze_wards"],
    }
)

# ---------------------------------------------------------------- gold tables

ORACLE["tb_06_dim_patient"] = with_views(["dim_patient"], "SELECT * FROM dim_patient")
ORACLE["tb_07_dim_ward"] = with_views(["dim_ward"], "SELECT * FROM dim_ward")

ORACLE["tb_08_dim_date"] = with_views(
    ["lab_results"],
    f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       dayname(d) AS day_name, monthname(d) AS month_name, {LAB_AS_OF} AS created_at,
       CAST(coalesce(s.n, 0) AS BIGINT) AS lab_samples
FROM (SELECT unnest(generate_series(DATE '2019-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS d) cal
LEFT JOIN (SELECT CAST(collected_time AS DATE) AS day_, count(*) AS n FROM lab_results GROUP BY 1) s
  ON CAST(cal.d AS DATE) = s.day_""",
)

ORACLE["tb_09_dim_drug"] = with_views(
    ["pharmacy_inventory"],
    f"""SELECT {skey('drug_name')} AS drug_key, drug_name, {LAB_AS_OF} AS created_at
FROM (SELECT DISTINCT drug_name FROM pharmacy_inventory)""",
)

ORACLE["tb_10_fact_admissions"] = with_views(["fact_admissions"], "SELECT * FROM fact_admissions")

ORACLE["tb_11_fact_labs"] = with_views(
    ["lab_results"],
    f"""SELECT {skey('lab_result_id', 'patient_id', ts_text('sample_time'))} AS lab_key,
       patient_id, sample_time, {LAB_AS_OF} AS created_at
FROM (SELECT lab_result_id, patient_id, coalesce(collected_time, {LAB_AS_OF}) AS sample_time FROM lab_results)""",
)

ORACLE["tb_12_fact_lab_turnaround"] = with_views(["fact_lab_turnaround"], "SELECT * FROM fact_lab_turnaround")
ORACLE["tb_13_fact_pharmacy"] = with_views(["fact_pharmacy"], "SELECT * FROM fact_pharmacy")
ORACLE["tb_14_fact_icu_alerts"] = with_views(["fact_icu_alerts"], "SELECT * FROM fact_icu_alerts")

# ---------------------------------------------------------------- silver

ORACLE["tb_01_silver_labs"] = with_views(
    ["silver_labs_dirty"],
    """SELECT lab_result_id, patient_id, test_type, test_date, result_value, collected_time, completed_time,
       sample_datetime, completed_datetime, turnaround_hours, silver_load_timestamp
FROM silver_labs_dirty""",
)
ORACLE["tb_02_silver_pharmacy"] = with_views(["silver_pharmacy_dirty"], "SELECT * FROM silver_pharmacy_dirty")
ORACLE["tb_03_silver_patients"] = with_views(["silver_patients_dirty"], "SELECT * FROM silver_patients_dirty")
ORACLE["tb_04_silver_admissions"] = with_views(["silver_admissions_dirty"], "SELECT * FROM silver_admissions_dirty")

ORACLE["jn_01_patient_admissions"] = with_views(
    ["silver_admissions_dirty", "silver_discharges_dirty", "silver_wards_dirty", "silver_patients_dirty"],
    f"""SELECT a.admission_id, a.patient_id, a.ward_id, a.admission_time,
       d.discharge_id, d.discharge_time, w.ward_name, w.capacity,
       p.first_name, p.last_name, p.gender, p.date_of_birth, {ADM_AS_OF} AS silver_load_timestamp
FROM silver_admissions_dirty a
LEFT JOIN (SELECT admission_id, discharge_id, discharge_time FROM silver_discharges_dirty
           QUALIFY row_number() OVER (PARTITION BY admission_id
                   ORDER BY discharge_time DESC NULLS LAST, discharge_id DESC NULLS LAST) = 1) d
  ON a.admission_id = d.admission_id
LEFT JOIN silver_wards_dirty w ON a.ward_id = w.ward_id
LEFT JOIN silver_patients_dirty p ON a.patient_id = p.patient_id""",
)

from . import oracle_profile  # noqa: E402,F401


# ---------------------------------------------------------------- quarantine and incremental silver

def _broken(e: str, read: str) -> str:
    return f"({e} IS NOT NULL AND trim({e}) <> '' AND {read} IS NULL)"


def _sides(source: str, key: str, view: str, rules: list[tuple[str, str]]) -> str:
    codes = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in rules)
    return f"""SELECT '{source}' AS source, CASE WHEN len(r) = 0 THEN 'accepted' ELSE 'rejected' END AS side, {lid(key)} AS row_id, array_to_string(r, ',') AS reasons
FROM (SELECT {key}, list_filter([{codes}], lambda x: x IS NOT NULL) AS r FROM {view})"""


ORACLE["prj_05_quarantine"] = with_views(
    ["bronze_lab_results", "bronze_pharmacy", "bronze_admissions"],
    "\nUNION ALL ".join([
        _sides("labs", "lab_result_id", "bronze_lab_results", [
            ("no_result_id", f"{lid('lab_result_id')} IS NULL"), ("no_patient", f"{lid('patient_id')} IS NULL"), ("no_test", "coalesce(trim(test_type), '') = ''"),
            ("bad_test_date", _broken("test_date", lts("test_date"))), ("bad_result", _broken("result_value", ldouble("result_value"))),
        ]),
        _sides("pharmacy", "drug_id", "bronze_pharmacy", [
            ("no_drug_id", f"{lid('drug_id')} IS NULL"), ("no_drug_name", "coalesce(trim(drug_name), '') = ''"),
            ("bad_quantity", _broken("quantity", ldouble("quantity"))), ("bad_expiry", _broken("expiry_date", lts("expiry_date"))),
        ]),
        _sides("admissions", "admission_id", "bronze_admissions", [
            ("no_admission_id", f"{lid('admission_id')} IS NULL"), ("no_patient", f"{lid('patient_id')} IS NULL"),
            ("bad_admission_date", _broken("admission_date", lts("admission_date"))),
        ]),
    ]),
)

# all snapshots at once: the latest of each key, unless that is its deletion
ORACLE["src_04_incremental_silver"] = with_views(
    ["bronze_patients"],
    f"""SELECT patient_id, first_name, last_name, dt FROM (
  SELECT * FROM (
    SELECT {llong('patient_id')} AS patient_id, first_name, last_name, dt, false AS gone FROM bronze_patients
    UNION ALL SELECT {llong('patient_id')}, first_name, 'late', '2001-07-15', false FROM bronze_patients WHERE dt = '2001-07-01' AND {llong('patient_id')} % 25 = 0
    UNION ALL SELECT {llong('patient_id')}, first_name, last_name, '2001-07-20', true FROM bronze_patients WHERE dt = '2001-07-01' AND {llong('patient_id')} % 40 = 0)
  QUALIFY patient_id IS NULL OR row_number() OVER (PARTITION BY patient_id ORDER BY dt DESC, first_name DESC NULLS LAST, last_name DESC NULLS LAST) = 1)
WHERE NOT gone""",
)

ORACLE["prj_12_key_registry"] = with_views(
    ["admissions"],
    """SELECT ward_id, patient_id, CAST(row_number() OVER (ORDER BY later, ward_id, patient_id) AS BIGINT) AS key_number
FROM (SELECT ward_id, patient_id, min(CASE WHEN triage_level = 1 THEN 0 ELSE 1 END) AS later FROM admissions GROUP BY 1, 2)""",
)
