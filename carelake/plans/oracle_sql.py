"""Independent DuckDB statements for the query catalogue.

The mapping views of ``carelake.sources.testviews`` are restated here as SQL
common table expressions over the raw test tables; each oracle statement is
``WITH <views> <body>``.  Nothing here is executed by the library itself.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["wards"] = """
SELECT CAST(n.n_nationkey AS BIGINT) AS ward_id, n.n_name AS ward_name, r.r_name AS ward_type,
       CAST((n.n_nationkey * 53) % 240 - 20 AS INTEGER) AS capacity
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

VIEWS["patients"] = """
SELECT c_custkey AS patient_id,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       DATE '1930-01-01' + CAST((c_custkey * 37) % 36500 AS INTEGER) AS date_of_birth,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'F' WHEN 'FURNITURE' THEN 'F' WHEN 'MACHINERY' THEN 'M'
            WHEN 'BUILDING' THEN 'M' WHEN 'AUTOMOBILE' THEN 'O' END AS gender
FROM customer"""

VIEWS["admissions"] = """
SELECT o.o_orderkey AS admission_id, o.o_custkey AS patient_id, CAST(c.c_nationkey AS BIGINT) AS ward_id,
       o.o_orderdate AS admission_time,
       CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS triage_level,
       CASE o.o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Discharged' WHEN 'P' THEN 'Transferred' END AS status
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

VIEWS["discharges"] = """
SELECT o.o_orderkey AS discharge_id, o.o_orderkey AS admission_id, o.o_custkey AS patient_id, l.discharge_time
FROM (SELECT l_orderkey, max(l_shipdate) AS discharge_time FROM lineitem GROUP BY l_orderkey) l
JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F'"""

VIEWS["lab_results"] = """
SELECT event_id AS lab_result_id, user_id AS patient_id,
       CASE event_type WHEN 'click' THEN 'Glucose' WHEN 'view' THEN 'Hemoglobin' WHEN 'purchase' THEN 'Sodium'
            WHEN 'error' THEN 'ALT' WHEN 'signup' THEN 'Renal Panel' END AS test_type,
       value AS result_value, 'mg/dL' AS unit, ts AS collected_time,
       ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS completed_time
FROM events"""

VIEWS["pharmacy_inventory"] = """
SELECT p_partkey AS drug_id, p_name AS drug_name, p_type AS category, p_brand AS supplier,
       p_size AS current_stock, CAST(p_partkey % 20 AS INTEGER) AS threshold, p_retailprice AS unit_price,
       DATE '2024-02-01' + CAST(p_partkey % 800 - 100 AS INTEGER) AS expiry_date
FROM part"""

VIEWS["icu_alerts"] = """
SELECT event_id AS alert_id, user_id AS patient_id, ts AS alert_time,
       ['HEART_RATE', 'SPO2', 'BLOOD_PRESSURE'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1] AS alert_type,
       CASE WHEN value >= 300 THEN 'CRITICAL' WHEN value >= 100 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM events WHERE event_type = 'error'"""

# --- gold over the clean views (run dates: 2001-08-01 admissions, 2024-02-01 labs/pharmacy)

ADM_AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
LAB_AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def skey(*exprs: str) -> str:
    """SQL twin of ``carelake.functions.keys.surrogate_key``."""
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), chr(0))" for e in exprs)
    return f"CAST(('0x' || substr(sha256(concat_ws('|', {parts})), 1, 15)) AS BIGINT)"


def ts_text(expr: str) -> str:
    """Spark's string form of a timestamp_ntz (fraction digits trimmed)."""
    return (
        f"CASE WHEN microsecond({expr}) % 1000000 = 0 THEN strftime({expr}, '%Y-%m-%d %H:%M:%S') "
        f"ELSE rtrim(strftime({expr}, '%Y-%m-%d %H:%M:%S.%f'), '0') END"
    )


VIEWS["fact_admissions"] = f"""
SELECT {skey('admission_id', 'patient_id', 'ward_id', ts_text('admission_time'))} AS admission_key,
       admission_id, patient_id, ward_id, admission_time, {ADM_AS_OF} AS created_at
FROM (SELECT admission_id, patient_id, ward_id, coalesce(admission_time, {ADM_AS_OF}) AS admission_time FROM admissions)"""

VIEWS["dim_ward"] = f"""
SELECT ward_id AS ward_key, ward_id, ward_name, {ADM_AS_OF} AS created_at FROM wards"""

VIEWS["dim_patient"] = f"""
SELECT patient_id AS patient_key, patient_id, first_name, last_name, date_of_birth AS birth_date,
       CAST(CASE WHEN date_of_birth IS NOT NULL THEN 2001 - year(date_of_birth) END AS INTEGER) AS age, gender,
       {ADM_AS_OF} AS created_at
FROM patients"""

VIEWS["fact_lab_turnaround"] = f"""
SELECT {skey('lab_result_id', 'patient_id', ts_text('sample_time'), ts_text('completed_time'))} AS lab_turnaround_key,
       patient_id, sample_time, completed_time,
       (floor(epoch(completed_time)) - floor(epoch(sample_time))) / 60.0 AS turnaround_minutes,
       {LAB_AS_OF} AS created_at
FROM (SELECT lab_result_id, patient_id, coalesce(collected_time, {LAB_AS_OF}) AS sample_time,
             coalesce(completed_time, {LAB_AS_OF}) AS completed_time FROM lab_results)"""

VIEWS["fact_pharmacy"] = f"""
SELECT {skey('drug_id', 'drug_name', 'stock_on_hand', 'reorder_level')} AS inventory_key,
       drug_name, stock_on_hand, reorder_level, {LAB_AS_OF} AS created_at
FROM (SELECT drug_id, drug_name, CAST(coalesce(current_stock, 0) AS INTEGER) AS stock_on_hand,
             CAST(coalesce(threshold, 10) AS INTEGER) AS reorder_level FROM pharmacy_inventory)"""

VIEWS["fact_icu_alerts"] = f"""
SELECT alert_id, patient_id, alert_time, alert_type, severity, {LAB_AS_OF} AS created_at FROM icu_alerts"""

# dependency order of the views
DEPENDS: dict[str, list[str]] = {
    "fact_admissions": ["admissions"],
    "dim_ward": ["wards"],
    "dim_patient": ["patients"],
    "fact_lab_turnaround": ["lab_results"],
    "fact_pharmacy": ["pharmacy_inventory"],
    "fact_icu_alerts": ["icu_alerts"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str):
        for dep in DEPENDS.get(n, []):
            visit(dep)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in _closure(names))
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH "):
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}

ORACLE["agg_04_daily_admissions_by_ward"] = with_views(
    ["fact_admissions", "dim_ward"],
    """SELECT strftime(a.admission_time, '%Y%m%d') AS date_key_str,
       CAST(strftime(a.admission_time, '%Y%m%d') AS INTEGER) AS date_key,
       a.ward_id, w.ward_name, CAST(count(*) AS BIGINT) AS admissions
FROM fact_admissions a LEFT JOIN dim_ward w ON a.ward_id = w.ward_id
GROUP BY 1, 2, 3, 4""",
)

ORACLE["agg_05_daily_lab_turnaround"] = with_views(
    ["fact_lab_turnaround"],
    """SELECT CAST(strftime(sample_time, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(count(*) AS BIGINT) AS tests_count,
       round(avg(turnaround_minutes), 6) AS avg_turnaround_minutes,
       CAST(sum(CASE WHEN turnaround_minutes > 120 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_tests_over_120m
FROM fact_lab_turnaround GROUP BY 1""",
)

ORACLE["agg_06_low_stock"] = with_views(
    ["fact_pharmacy"],
    """SELECT CAST(count(*) AS BIGINT) AS total_items,
       CAST(sum(CASE WHEN stock_on_hand <= reorder_level THEN 1 ELSE 0 END) AS BIGINT) AS low_stock_items,
       CAST(sum(CASE WHEN stock_on_hand <= reorder_level THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*) AS low_stock_pct
FROM fact_pharmacy""",
)

ORACLE["agg_07_daily_icu_alerts"] = with_views(
    ["fact_icu_alerts"],
    """SELECT CAST(strftime(alert_time, '%Y%m%d') AS INTEGER) AS date_key, alert_type, severity,
       CAST(count(*) AS BIGINT) AS alerts_count
FROM fact_icu_alerts GROUP BY 1, 2, 3""",
)

ORACLE["agg_03_daily_admissions_summary"] = with_views(
    ["fact_admissions"],
    """SELECT strftime(admission_time, '%Y-%m-%d') AS admission_date, CAST(count(*) AS BIGINT) AS daily_admissions,
       CAST(count(DISTINCT patient_id) AS BIGINT) AS unique_patients, CAST(count(DISTINCT ward_id) AS BIGINT) AS active_wards
FROM fact_admissions GROUP BY 1 ORDER BY 1""",
)

ORACLE["jn_04_patient_summary"] = with_views(
    ["fact_admissions", "dim_patient"],
    f"""SELECT p.patient_key, p.patient_id, p.first_name, p.last_name, p.age, p.gender,
       CAST(coalesce(c.admission_count, 0) AS BIGINT) AS total_admissions, {ADM_AS_OF} AS created_at
FROM dim_patient p LEFT JOIN (SELECT patient_id, count(*) AS admission_count FROM fact_admissions GROUP BY 1) c
  ON p.patient_id = c.patient_id""",
)

ORACLE["agg_02_patient_summary_fallback"] = with_views(
    ["dim_patient"],
    f"""SELECT patient_key, patient_id, first_name, last_name, age, gender,
       CAST(1 AS BIGINT) AS total_admissions, {ADM_AS_OF} AS created_at
FROM dim_patient""",
)


def all_oracles() -> dict[str, str]:
    from . import oracle_more  # noqa: F401

    return dict(ORACLE)
