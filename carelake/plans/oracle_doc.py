"""Oracle statements for the documented second wave (DOC-01..15)."""

from __future__ import annotations

from .oracle_more import ldate, llong
from .oracle_profile import classify_sql
from .oracle_sql import ADM_AS_OF, DEPENDS, LAB_AS_OF, ORACLE, VIEWS, skey, with_views

VIEWS["vital_signs"] = """
SELECT event_id AS reading_id, user_id AS patient_id, ts AS measurement_time,
       CASE WHEN event_id % 211 = 9 THEN NULL ELSE CAST(35 + floor(value * 7) % 110 AS INTEGER) END AS heart_rate,
       CASE WHEN event_id % 37 = 5 OR event_id % 211 = 9 THEN NULL ELSE CAST(85 + floor(value) % 140 AS INTEGER) END AS blood_pressure_systolic,
       CAST(45 + event_id % 60 AS INTEGER) AS blood_pressure_diastolic,
       CASE WHEN event_id % 211 = 9 THEN NULL ELSE CAST(35.0 AS DOUBLE) + CAST(event_id % 60 AS DOUBLE) / CAST(10.0 AS DOUBLE) END AS temperature,
       CASE WHEN event_id % 211 = 9 THEN NULL ELSE CAST(88 + event_id % 13 AS INTEGER) END AS oxygen_saturation,
       CASE WHEN event_id % 31 = 4 OR event_id % 211 = 9 THEN NULL ELSE CAST(8 + event_id % 23 AS INTEGER) END AS respiratory_rate
FROM events"""


def band(x: str, edges: list[tuple[float, int]], top: int) -> str:
    whens = " ".join(f"WHEN {x} <= {e} THEN {s}" for e, s in edges)
    return f"(CASE {whens} WHEN {x} IS NOT NULL THEN {top} END)"


RESP = ([(8, 3), (11, 1), (20, 0), (24, 2)], 3)
SPO2 = ([(91, 3), (93, 2), (95, 1)], 0)
SYS = ([(90, 3), (100, 2), (110, 1), (219, 0)], 3)
PULSE = ([(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)], 3)
TEMP = ([(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)], 2)

VIEWS["vital_facts"] = f"""
SELECT {skey('reading_id')} AS vital_key, reading_id, patient_id, measurement_time AS measurement_timestamp,
       CAST(strftime(measurement_time, '%Y%m%d') AS INTEGER) AS measurement_date_key,
       CAST(hour(measurement_time) AS INTEGER) AS measurement_time_key,
       heart_rate, blood_pressure_systolic, blood_pressure_diastolic, temperature, oxygen_saturation, respiratory_rate,
       CAST(list_sum([r, o, s, p, t]) AS INTEGER) AS ews_score,
       CAST(5 - list_count([r, o, s, p, t]) AS INTEGER) AS missing_readings,
       coalesce(list_sum([r, o, s, p, t]) >= 7 OR list_max([r, o, s, p, t]) >= 3, false) AS is_critical,
       CASE WHEN blood_pressure_systolic IS NULL OR blood_pressure_diastolic IS NULL THEN 'Unknown'
            WHEN blood_pressure_systolic >= 140 OR blood_pressure_diastolic >= 90 THEN 'Stage 2 Hypertension'
            WHEN blood_pressure_systolic >= 130 OR blood_pressure_diastolic >= 80 THEN 'Stage 1 Hypertension'
            WHEN blood_pressure_systolic >= 120 THEN 'Elevated' ELSE 'Normal' END AS bp_category,
       coalesce(heart_rate BETWEEN 30 AND 250 AND oxygen_saturation BETWEEN 70 AND 100 AND temperature BETWEEN 30 AND 45
         AND blood_pressure_systolic BETWEEN 70 AND 250 AND blood_pressure_diastolic BETWEEN 40 AND 150 AND respiratory_rate BETWEEN 5 AND 60
         AND blood_pressure_systolic > blood_pressure_diastolic, false) AS in_valid_range
FROM (SELECT *, {band('respiratory_rate', *RESP)} AS r, {band('oxygen_saturation', *SPO2)} AS o,
             {band('blood_pressure_systolic', *SYS)} AS s, {band('heart_rate', *PULSE)} AS p,
             {band('temperature', *TEMP)} AS t FROM vital_signs)"""

VIEWS["adm_facts"] = f"""
SELECT {skey('a.admission_id')} AS admission_key, a.admission_id, patient_id, ward_id,
       admission_time AS admission_timestamp,
       CAST(strftime(admission_time, '%Y%m%d') AS INTEGER) AS admission_date_key,
       CAST(hour(admission_time) AS INTEGER) AS admission_time_key, triage_level,
       CASE WHEN d.discharge_time IS NOT NULL THEN 'Discharged' ELSE coalesce(status, 'Active') END AS admission_status,
       d.discharge_time AS discharge_timestamp,
       greatest(0.0, (floor(epoch(coalesce(d.discharge_time, {ADM_AS_OF}))) - floor(epoch(admission_time))) / 3600.0) AS occupancy_hours,
       CAST(d.discharge_time IS NOT NULL AS INTEGER) AS is_discharged
FROM admissions a LEFT JOIN (
  SELECT admission_id, discharge_time FROM discharges
  QUALIFY row_number() OVER (PARTITION BY admission_id ORDER BY discharge_time DESC NULLS LAST) = 1) d
  ON a.admission_id = d.admission_id"""

# beds: a stay opens a bed if more overlap than before, else the r-th reuse takes the bed of the r-th discharge
VIEWS["bed_events"] = f"""
WITH s AS (SELECT admission_id, ward_id, admission_timestamp AS s, coalesce(discharge_timestamp, {ADM_AS_OF}) AS e FROM adm_facts),
v AS (SELECT admission_id, ward_id, s AS t, 1 AS kind FROM s WHERE e >= s
      UNION ALL SELECT admission_id, ward_id, e, CASE WHEN s = e THEN 2 ELSE 0 END FROM s WHERE e >= s),
c AS (SELECT *, sum(CASE kind WHEN 1 THEN 1 ELSE -1 END) OVER o AS n, count_if(kind = 1) OVER o AS starts, count_if(kind <> 1) OVER o AS ends
      FROM v WINDOW o AS (PARTITION BY ward_id ORDER BY t, kind, admission_id))
SELECT *, coalesce(max(n) OVER (PARTITION BY ward_id ORDER BY t, kind, admission_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS peak FROM c"""

VIEWS["bed_links"] = """
SELECT a.admission_id, CASE WHEN a.n > a.peak THEN a.n END AS bed, b.admission_id AS up
FROM (SELECT * FROM bed_events WHERE kind = 1) a LEFT JOIN (SELECT * FROM bed_events WHERE kind <> 1) b
  ON a.n <= a.peak AND a.ward_id IS NOT DISTINCT FROM b.ward_id AND b.ends = a.starts - a.peak"""

VIEWS["beds"] = """
SELECT admission_id, bed FROM (
  WITH RECURSIVE r AS (SELECT admission_id, bed FROM bed_links WHERE bed IS NOT NULL
    UNION ALL SELECT l.admission_id, r.bed FROM r JOIN bed_links l ON l.up = r.admission_id) SELECT * FROM r)"""

VIEWS["lab_facts"] = f"""
SELECT {skey('lab_result_id')} AS lab_result_key, lab_result_id, patient_id, sample_datetime AS sample_timestamp,
       CAST(strftime(sample_datetime, '%Y%m%d') AS INTEGER) AS sample_date_key, completed_datetime AS completion_timestamp,
       test_type AS test_name,
       CASE WHEN lower(coalesce(test_type, '')) LIKE '%urine%' THEN 'Urine Test'
            WHEN regexp_matches(lower(coalesce(test_type, '')), 'x-ray|xray|mri|scan|imaging|ultrasound') THEN 'Imaging'
            WHEN {classify_sql('test_type')} IS NOT NULL
                 OR regexp_matches(lower(coalesce(test_type, '')), 'blood|panel|count|function') THEN 'Blood Test'
            ELSE 'Other Test' END AS test_category,
       CAST(result_value AS VARCHAR) AS result, tat AS turnaround_minutes, tat > 120 AS is_delayed, tat < 240 AS meets_sla,
       CASE WHEN completed_datetime IS NOT NULL THEN 'Completed' ELSE 'Pending' END AS status_standardized,
       CAST(completed_datetime IS NOT NULL AS INTEGER) AS is_completed
FROM (SELECT *, (floor(epoch(completed_datetime)) - floor(epoch(sample_datetime))) / 60.0 AS tat FROM (
      SELECT lab_result_id, patient_id, test_type, result_value, collected_time AS sample_datetime,
             completed_time AS completed_datetime FROM lab_results))"""

VIEWS["pharm_facts"] = f"""
SELECT {skey('drug_id', "DATE '2024-02-01'")} AS inventory_key, drug_id, drug_name, DATE '2024-02-01' AS snapshot_date,
       20240201 AS snapshot_date_key, current_stock AS stock_on_hand, threshold AS reorder_level, unit_price,
       current_stock * unit_price AS stock_value, CAST(date_diff('day', DATE '2024-02-01', expiry_date) AS INTEGER) AS days_until_expiry,
       date_diff('day', DATE '2024-02-01', expiry_date) BETWEEN 0 AND 30 AS expiring_soon,
       current_stock < threshold AS low_stock, CAST(current_stock < threshold AS INTEGER) AS low_stock_flag,
       CAST(date_diff('day', DATE '2024-02-01', expiry_date) BETWEEN 0 AND 30 AS INTEGER) AS expiring_soon_flag
FROM pharmacy_inventory"""

VIEWS["dim_std"] = f"""
SELECT patient_id AS patient_key, patient_id, first_name, last_name, date_of_birth AS birth_date,
       CAST(CASE WHEN date_of_birth IS NOT NULL THEN 2001 - year(date_of_birth) END AS INTEGER) AS age,
       CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'M' WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'F' ELSE 'O' END
         AS gender_standardized,
       (2001 - year(date_of_birth)) BETWEEN 0 AND 120 AS age_valid
FROM patients"""

DEPENDS.update(
    {
        "vital_facts": ["vital_signs"],
        "adm_facts": ["admissions", "discharges"],
        "bed_events": ["adm_facts"],
        "bed_links": ["bed_events"],
        "beds": ["bed_links"],
        "lab_facts": ["lab_results"],
        "pharm_facts": ["pharmacy_inventory"],
        "dim_std": ["patients"],
    }
)

ORACLE["doc_01_calendar"] = with_views(
    ["lab_results"],
    f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       dayname(d) AS day_name, monthname(d) AS month_name, {LAB_AS_OF} AS created_at,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CASE WHEN dayofweek(d) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       last_day(d) AS month_end_date, CAST(date_diff('day', d, last_day(d)) AS INTEGER) AS days_until_month_end,
       CAST(coalesce(s.n, 0) AS BIGINT) AS lab_samples
FROM (SELECT CAST(unnest(generate_series(DATE '2019-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS d) cal
LEFT JOIN (SELECT CAST(collected_time AS DATE) AS day_, count(*) AS n FROM lab_results GROUP BY 1) s ON cal.d = s.day_""",
)

ORACLE["doc_02_dim_time"] = with_views(
    ["lab_results"],
    """SELECT CAST(h AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour, printf('%02d:00', h) AS hour_display,
       CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day,
       CASE WHEN h >= 9 AND h < 17 THEN 'Business Hours' ELSE 'Non-Business Hours' END AS business_hours_flag,
       CAST(coalesce(s.n, 0) AS BIGINT) AS lab_samples
FROM range(24) t(h) LEFT JOIN (SELECT hour(collected_time) AS hh, count(*) AS n FROM lab_results GROUP BY 1) s ON t.h = s.hh""",
)

ORACLE["doc_03_patient_scd2"] = with_views(
    ["bronze_patients"],
    f"""WITH typed AS (
  SELECT {llong('patient_id')} AS patient_id, first_name, last_name, gender, {ldate('date_of_birth')} AS date_of_birth, dt
  FROM bronze_patients),
snap AS (SELECT * FROM typed WHERE patient_id IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY patient_id, dt ORDER BY first_name DESC NULLS LAST, last_name DESC NULLS LAST,
                 gender DESC NULLS LAST, date_of_birth DESC NULLS LAST) = 1),
marked AS (SELECT *, lag(first_name) OVER w AS pf, lag(last_name) OVER w AS pl, lag(gender) OVER w AS pg,
                  lag(date_of_birth) OVER w AS pd, row_number() OVER w AS rn
           FROM snap WINDOW w AS (PARTITION BY patient_id ORDER BY dt)),
versions AS (SELECT * FROM marked WHERE rn = 1 OR first_name IS DISTINCT FROM pf OR last_name IS DISTINCT FROM pl
             OR gender IS DISTINCT FROM pg OR date_of_birth IS DISTINCT FROM pd)
SELECT patient_id, first_name, last_name, gender, date_of_birth, dt AS valid_from,
       lead(dt) OVER (PARTITION BY patient_id ORDER BY dt) AS valid_to,
       CASE WHEN lead(dt) OVER (PARTITION BY patient_id ORDER BY dt) IS NULL THEN 1 ELSE 0 END AS current_row_flag
FROM versions""",
)

ORACLE["doc_04_ward_utilisation"] = with_views(
    ["wards", "adm_facts"],
    f"""SELECT w.ward_id AS ward_key, w.ward_id, ward_name, ward_type,
       CASE WHEN upper(coalesce(ward_type, '')) IN ('ICU', 'EMERGENCY') THEN 'Critical'
            WHEN upper(coalesce(ward_type, '')) IN ('PEDIATRIC', 'MATERNITY', 'SURGICAL') THEN 'Specialized' ELSE 'General' END AS ward_category,
       capacity AS total_beds, CAST(coalesce(o.n, 0) AS BIGINT) AS beds_occupied,
       greatest(capacity - CAST(coalesce(o.n, 0) AS BIGINT), 0) AS available_beds,
       CASE WHEN capacity = 0 THEN NULL ELSE round(CAST(coalesce(o.n, 0) AS DOUBLE) * 100.0 / capacity, 2) END AS utilization_rate
FROM wards w LEFT JOIN (
  SELECT ward_id, count(*) AS n FROM adm_facts WHERE admission_timestamp <= {ADM_AS_OF}
    AND (discharge_timestamp IS NULL OR discharge_timestamp > {ADM_AS_OF}) GROUP BY 1) o ON w.ward_id = o.ward_id""",
)

ORACLE["doc_05_vital_signs"] = with_views(["vital_facts"], "SELECT * FROM vital_facts")

ORACLE["doc_05_icu_alerts_kpi"] = with_views(
    ["vital_facts"],
    """SELECT CAST(strftime(measurement_timestamp, '%Y%m%d') AS INTEGER) AS date_key, 'CRITICAL_VITALS' AS alert_type,
       CASE WHEN ews_score >= 7 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, CAST(count(*) AS BIGINT) AS alerts_count
FROM vital_facts WHERE is_critical GROUP BY 1, 2, 3""",
)

ORACLE["doc_06_lab_flags"] = with_views(["lab_facts"], "SELECT * FROM lab_facts")
ORACLE["doc_07_pharmacy_flags"] = with_views(["pharm_facts"], "SELECT * FROM pharm_facts")
ORACLE["doc_08_admission_facts"] = with_views(["adm_facts"], "SELECT * FROM adm_facts")
ORACLE["doc_09_bed_stays"] = with_views(
    ["adm_facts", "beds"],
    """SELECT f.admission_id, f.ward_id,
       CASE WHEN admission_timestamp IS NULL OR discharge_timestamp < admission_timestamp THEN 'invalid'
            WHEN discharge_timestamp IS NULL THEN 'open' ELSE 'closed' END AS stay_status,
       CAST(bed AS BIGINT) AS bed
FROM adm_facts f LEFT JOIN beds USING (admission_id)""",
)

# every stay is laid out day by day, and what falls on one bed and day is added up
ORACLE["doc_09_bed_occupancy"] = with_views(
    ["adm_facts", "beds"],
    f"""SELECT ward_id, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS occupancy_date_key, CAST(count(*) AS BIGINT) AS beds_occupied,
       CAST(count_if(last < CAST(day + 1 AS TIMESTAMP)) AS BIGINT) AS beds_cleaning, min(bed) AS first_bed, max(bed) AS last_bed,
       max((ward_id * 1048576 + CAST(bed[2:] AS BIGINT)) * 131072 + date_diff('day', DATE '1900-01-01', day)) AS last_key,
       round(sum(h), 6) AS occupancy_hours
FROM (SELECT ward_id, bed, day, max(e) AS last,
             sum((floor(epoch(least(e, CAST(day + 1 AS TIMESTAMP)))) - floor(epoch(greatest(s, CAST(day AS TIMESTAMP))))) / 3600.0) AS h
      FROM (SELECT ward_id, 'B' || lpad(CAST(CAST(bed AS BIGINT) AS VARCHAR), 6, '0') AS bed, s, e,
                   CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
            FROM (SELECT ward_id, bed, admission_timestamp AS s, coalesce(discharge_timestamp, {ADM_AS_OF}) AS e
                  FROM adm_facts JOIN beds USING (admission_id))) GROUP BY ALL) GROUP BY 1, 2""",
)

# every bed-day, open stays up to the run date, added up by day and ward
VIEWS["bed_days"] = f"""
SELECT ward_id, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key,
       (floor(epoch(least(e, CAST(day + 1 AS TIMESTAMP)))) - floor(epoch(greatest(s, CAST(day AS TIMESTAMP))))) / 3600.0 AS hours
FROM (SELECT ward_id, s, e, CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT ward_id, admission_timestamp AS s, coalesce(discharge_timestamp, {ADM_AS_OF}) AS e FROM adm_facts) WHERE e >= s)"""
DEPENDS["bed_days"] = ["adm_facts"]

ORACLE["doc_10_daily_operations"] = with_views(
    ["adm_facts", "bed_days", "wards"],
    """SELECT g.date_key, g.ward_id, w.ward_name, w.ward_type, w.capacity AS total_beds,
       CAST(a AS BIGINT) AS admission_count, CAST(d AS BIGINT) AS discharge_count, CAST(o AS BIGINT) AS occupied_beds,
       round(h, 6) AS total_occupancy_hours,
       CASE WHEN w.capacity = 0 THEN NULL ELSE round(CAST(o AS DOUBLE) * 100.0 / w.capacity, 2) END AS occupancy_rate
FROM (SELECT date_key, ward_id, sum(a) AS a, sum(d) AS d, sum(o) AS o, sum(h) AS h FROM (
        SELECT admission_date_key AS date_key, ward_id, 1 AS a, 0 AS d, 0 AS o, 0.0 AS h FROM adm_facts WHERE admission_timestamp IS NOT NULL
        UNION ALL SELECT CAST(strftime(discharge_timestamp, '%Y%m%d') AS INTEGER), ward_id, 0, 1, 0, 0.0 FROM adm_facts WHERE discharge_timestamp IS NOT NULL
        UNION ALL SELECT date_key, ward_id, 0, 0, 1, hours FROM bed_days) GROUP BY 1, 2) g
LEFT JOIN wards w ON g.ward_id = w.ward_id""",
)

ORACLE["doc_11_patient_care"] = with_views(
    ["vital_facts", "lab_facts"],
    """SELECT date_key, critical_vitals_count, patients_with_critical_vitals, avg_ews_score,
       completed_tests, avg_turnaround_minutes, delayed_tests_count
FROM (SELECT measurement_date_key AS date_key, CAST(count_if(is_critical) AS BIGINT) AS critical_vitals_count,
             CAST(count(DISTINCT CASE WHEN is_critical THEN patient_id END) AS BIGINT) AS patients_with_critical_vitals,
             round(avg(ews_score), 6) AS avg_ews_score FROM vital_facts GROUP BY 1) v
FULL OUTER JOIN (SELECT sample_date_key AS date_key, CAST(sum(is_completed) AS BIGINT) AS completed_tests,
             round(avg(turnaround_minutes), 6) AS avg_turnaround_minutes, CAST(count_if(is_delayed) AS BIGINT) AS delayed_tests_count
             FROM lab_facts GROUP BY 1) l USING (date_key)""",
)

ORACLE["doc_12_pharmacy_kpi"] = with_views(
    ["pharm_facts"],
    """SELECT snapshot_date_key, CAST(count(*) AS BIGINT) AS total_drugs, round(sum(stock_value), 6) AS total_inventory_value,
       CAST(count_if(low_stock) AS BIGINT) AS low_stock_items, CAST(count_if(expiring_soon) AS BIGINT) AS expiring_soon_items,
       round(avg(days_until_expiry), 6) AS avg_days_until_expiry,
       round(CAST(count_if(low_stock) AS DOUBLE) * 100.0 / count(*), 2) AS low_stock_percentage
FROM pharm_facts GROUP BY 1""",
)

ORACLE["doc_13_patient_summary_ext"] = with_views(
    ["dim_std", "adm_facts", "vital_facts"],
    """SELECT p.patient_key, p.patient_id, p.first_name, p.last_name, p.age, p.gender_standardized,
       CAST(coalesce(a.total_admissions, 0) AS BIGINT) AS total_admissions,
       CAST(coalesce(a.total_discharges, 0) AS BIGINT) AS total_discharges,
       round(a.avg_triage_level, 2) AS avg_triage_level,
       CAST(coalesce(v.total_vital_readings, 0) AS BIGINT) AS total_vital_readings,
       CAST(coalesce(v.critical_readings_count, 0) AS BIGINT) AS critical_readings_count,
       round(v.avg_ews_score, 2) AS avg_ews_score, round(v.avg_heart_rate, 2) AS avg_heart_rate
FROM dim_std p
LEFT JOIN (SELECT patient_id, count(*) AS total_admissions, sum(is_discharged) AS total_discharges,
                  avg(triage_level) AS avg_triage_level FROM adm_facts GROUP BY 1) a ON p.patient_id = a.patient_id
LEFT JOIN (SELECT patient_id, count(*) AS total_vital_readings, count_if(is_critical) AS critical_readings_count,
                  avg(ews_score) AS avg_ews_score, avg(heart_rate) AS avg_heart_rate FROM vital_facts GROUP BY 1) v
  ON p.patient_id = v.patient_id""",
)


def _rule(suite: str, table: str, name: str, pred: str, msg: str) -> str:
    return (
        f"SELECT '{suite}' AS suite, '{name}' AS \"check\", 'issue' AS severity, failed, failed > 0 AS fired, "
        f"CASE WHEN failed > 0 THEN printf('{msg}', failed) END AS message "
        f"FROM (SELECT CAST(count_if({pred}) AS BIGINT) AS failed FROM {table})"
    )


def _rows(suite: str, table: str) -> str:
    return (f"SELECT '{suite}' AS suite, 'row_count' AS \"check\", 'metric' AS severity, CAST(count(*) AS BIGINT) AS failed, "
            f"false AS fired, CAST(NULL AS VARCHAR) AS message FROM {table}")


ORACLE["doc_14_rules"] = with_views(
    ["adm_facts", "pharmacy_inventory", "vital_facts", "dim_std"],
    "\nUNION ALL\n".join(
        [
            _rows("rules_admissions", "adm_facts"),
            _rows("rules_pharmacy", "pharmacy_inventory"),
            _rows("rules_vitals", "vital_facts"),
            _rows("rules_patients", "dim_std"),
            _rule("rules_admissions", "adm_facts", "discharge_before_admission", "discharge_timestamp < admission_timestamp", "%d discharges before admission"),
            _rule("rules_admissions", "adm_facts", "triage_out_of_range", "NOT (triage_level BETWEEN 1 AND 5)", "%d triage levels outside 1-5"),
            _rule("rules_admissions", "adm_facts", "active_without_ward", "admission_status = 'Active' AND ward_id IS NULL", "%d active admissions without ward"),
            _rule("rules_pharmacy", "pharmacy_inventory", "negative_stock", "current_stock < 0", "%d negative stock quantities"),
            _rule("rules_pharmacy", "pharmacy_inventory", "non_positive_price", "unit_price <= 0", "%d non-positive unit prices"),
            _rule("rules_vitals", "vital_facts", "heart_rate_range", "NOT (heart_rate BETWEEN 30 AND 250)", "%d heart rates outside 30-250"),
            _rule("rules_vitals", "vital_facts", "spo2_range", "NOT (oxygen_saturation BETWEEN 70 AND 100)", "%d oxygen saturations outside 70-100"),
            _rule("rules_vitals", "vital_facts", "temperature_range", "NOT (temperature BETWEEN 30 AND 45)", "%d temperatures outside 30-45"),
            _rule("rules_vitals", "vital_facts", "systolic_not_above_diastolic", "blood_pressure_systolic <= blood_pressure_diastolic",
                  "%d readings with systolic <= diastolic"),
            _rule("rules_patients", "dim_std", "age_out_of_range", "NOT age_valid", "%d ages outside 0-120"),
            _rule("rules_patients", "dim_std", "gender_not_standard", "gender_standardized NOT IN ('M', 'F', 'O')", "%d non-standard genders"),
        ]
    ),
)

ORACLE["doc_15_pseudonymised"] = with_views(
    ["patients"],
    f"""SELECT sha256('carelake-test-salt' || CAST(patient_id AS VARCHAR)) AS patient_token,
       CAST(year(date_of_birth) AS INTEGER) AS birth_year,
       CAST(CASE WHEN date_of_birth IS NOT NULL THEN 2001 - year(date_of_birth) END AS INTEGER) AS age,
       CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'M' WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'F' ELSE 'O' END
         AS gender_standardized
FROM patients""",
)

_N = "CAST(count(*) AS BIGINT)"
ORACLE["run_01_medallion_build"] = with_views(
    ["bronze_lab_results", "bronze_pharmacy", "silver_patients_dirty", "silver_admissions_dirty",
     "silver_discharges_dirty", "silver_wards_dirty", "silver_labs_dirty", "silver_pharmacy_dirty"],
    f"""SELECT 'silver' AS layer, 'lab_results' AS "table", (SELECT {_N} FROM bronze_lab_results) AS rows, 'ok' AS status
UNION ALL SELECT 'silver', 'pharmacy_inventory', (SELECT {_N} FROM bronze_pharmacy), 'ok'
UNION ALL SELECT 'silver', 'patients', (SELECT {_N} FROM silver_patients_dirty), 'ok'
UNION ALL SELECT 'silver', 'admissions', (SELECT {_N} FROM silver_admissions_dirty), 'ok'
UNION ALL SELECT 'silver', 'discharges', (SELECT {_N} FROM silver_discharges_dirty), 'ok'
UNION ALL SELECT 'silver', 'wards', (SELECT {_N} FROM silver_wards_dirty), 'ok'
UNION ALL SELECT 'silver', 'patient_admissions', (SELECT {_N} FROM silver_admissions_dirty), 'ok'
UNION ALL SELECT 'gold', 'dim_patient', (SELECT {_N} FROM silver_patients_dirty), 'ok'
UNION ALL SELECT 'gold', 'dim_ward', (SELECT {_N} FROM silver_wards_dirty), 'ok'
UNION ALL SELECT 'gold', 'dim_date', CAST(2922 AS BIGINT), 'ok'
UNION ALL SELECT 'gold', 'dim_drug', (SELECT {_N} FROM (SELECT DISTINCT drug_name FROM bronze_pharmacy)), 'ok'
UNION ALL SELECT 'gold', 'fact_admissions', (SELECT {_N} FROM silver_admissions_dirty), 'ok'
UNION ALL SELECT 'gold', 'fact_labs', (SELECT {_N} FROM silver_labs_dirty), 'ok'
UNION ALL SELECT 'gold', 'fact_lab_turnaround', (SELECT {_N} FROM silver_labs_dirty), 'ok'
UNION ALL SELECT 'gold', 'fact_pharmacy', (SELECT {_N} FROM silver_pharmacy_dirty), 'ok'
UNION ALL SELECT 'gold', 'fact_icu_alerts', CAST(0 AS BIGINT), 'ok'
UNION ALL SELECT 'gold', 'fact_pharmacy_stock', (SELECT {_N} FROM silver_pharmacy_dirty), 'ok'
UNION ALL SELECT 'gold', 'patient_summary', (SELECT {_N} FROM silver_patients_dirty), 'ok'
UNION ALL SELECT 'gold', 'daily_admissions_summary', (SELECT {_N} FROM (SELECT DISTINCT
    strftime(coalesce(admission_time, {LAB_AS_OF}), '%Y-%m-%d') FROM silver_admissions_dirty)), 'ok'""",
)

ORACLE["str_01_incremental_labs"] = ORACLE["tb_01_silver_labs"]

# ---------------------------------------------------------------- suite metrics

from .oracle_more import ldouble, lts  # noqa: E402


def _m(suite: str, metric: str, item: str, value: str, text: str, src: str) -> str:
    return (f"SELECT '{suite}' AS suite, '{metric}' AS metric, CAST({item} AS VARCHAR) AS item, "
            f"CAST({value} AS DOUBLE) AS value, CAST({text} AS VARCHAR) AS text FROM {src}")


def _dist(suite: str, metric: str, col: str, table: str, top: int | None = None) -> str:
    lim = f" ORDER BY n DESC, v ASC LIMIT {top}" if top else ""
    return _m(suite, metric, "v", "n", "NULL", f"(SELECT {col} AS v, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY 1{lim})")


_ISO = "'%Y-%m-%dT%H:%M:%S'"

ORACLE["vs_01_metrics"] = with_views(
    ["bronze_patients"],
    "\nUNION ALL\n".join([
        _m("patients", "total_patients", "NULL", "count(*)", "NULL", "bronze_patients"),
        _m("patients", "average_age", "NULL",
           f"round(avg(floor((epoch({ADM_AS_OF}) - epoch({lts('date_of_birth')})) / 86400)) / 365.25, 2)", "NULL", "bronze_patients"),
        _dist("patients", "gender_distribution", "gender", "bronze_patients"),
    ]),
)

ORACLE["vs_02_metrics"] = with_views(
    ["bronze_admissions"],
    "\nUNION ALL\n".join([
        _m("admissions", "total_admissions", "NULL", "count(*)", "NULL", "bronze_admissions"),
        _m("admissions", "latest_admission", "NULL", "NULL", f"strftime(max({lts('admission_date')}), {_ISO})", "bronze_admissions"),
        _m("admissions", "earliest_admission", "NULL", "NULL", f"strftime(min({lts('admission_date')}), {_ISO})", "bronze_admissions"),
        _dist("admissions", "top_wards", "ward_id", "bronze_admissions", top=10),
    ]),
)

ORACLE["vs_06_metrics"] = with_views(
    ["bronze_pharmacy"],
    "\nUNION ALL\n".join([
        _m("pharmacy", "total_drugs", "NULL", "count(*)", "NULL", "bronze_pharmacy"),
        _m("pharmacy", "expired_drugs", "NULL", f"count_if({lts('expiry_date')} < {LAB_AS_OF})", "NULL", "bronze_pharmacy"),
        _m("pharmacy", "total_quantity", "NULL", f"sum({ldouble('quantity')})", "NULL", "bronze_pharmacy"),
        _m("pharmacy", "avg_quantity", "NULL", f"avg({ldouble('quantity')})", "NULL", "bronze_pharmacy"),
        _dist("pharmacy", "drug_categories", "category", "bronze_pharmacy"),
        _dist("pharmacy", "top_suppliers", "supplier", "bronze_pharmacy", top=5),
    ]),
)

_LB = f"""(SELECT patient_id, test_type, {lts('test_date')} AS t, {ldouble('result_value')} AS x,
          lower(trim(test_type)) AS std FROM bronze_lab_results)"""

ORACLE["vs_08_summary"] = with_views(
    ["bronze_lab_results"],
    "\nUNION ALL\n".join([
        _m("lab_results", "total_tests", "NULL", "count(*)", "NULL", _LB),
        _m("lab_results", "unique_patients", "NULL", "count(DISTINCT patient_id)", "NULL", _LB),
        _m("lab_results", "unique_test_types", "NULL", "count(DISTINCT test_type)", "NULL", _LB),
        _m("lab_results", "unique_standardised_test_types", "NULL", "count(DISTINCT std)", "NULL", _LB),
        _m("lab_results", "date_range_start", "NULL", "NULL", f"strftime(min(t), {_ISO})", _LB),
        _m("lab_results", "date_range_end", "NULL", "NULL", f"strftime(max(t), {_ISO})", _LB),
        _m("lab_results", "avg_tests_per_day", "NULL", "CAST(count(t) AS DOUBLE) / count(DISTINCT CAST(t AS DATE))", "NULL", _LB),
        _m("lab_results", "result_mean", "NULL", "round(avg(x), 6)", "NULL", _LB),
        _m("lab_results", "result_median", "NULL", "round(median(x), 6)", "NULL", _LB),
        _m("lab_results", "result_std", "NULL", "round(stddev_samp(x), 6)", "NULL", _LB),
        _m("lab_results", "result_min", "NULL", "min(x)", "NULL", _LB),
        _m("lab_results", "result_max", "NULL", "max(x)", "NULL", _LB),
        _dist("lab_results", "test_type_distribution", "std", _LB, top=20),
        _m("lab_results", "unclassified_test_types", "v", "NULL", "NULL",
           f"(SELECT DISTINCT std AS v FROM {_LB} WHERE x IS NOT NULL AND std IS NOT NULL AND {classify_sql('std')} IS NULL ORDER BY 1 LIMIT 10)"),
    ]),
)
