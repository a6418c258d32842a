"""Gold table contracts (types per the reference DDL) and a contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import _parse_datatype_string

# Gold contracts.  Timestamps are wall-clock (timestamp_ntz).
GOLD_CONTRACTS: dict[str, str] = {
    "dim_patient": "patient_key bigint, patient_id bigint, first_name string, last_name string, birth_date date, age int, gender string, created_at timestamp_ntz",
    "dim_ward": "ward_key bigint, ward_id bigint, ward_name string, created_at timestamp_ntz",
    "dim_date": "date_key int, full_date date, year int, month int, day int, day_name string, month_name string, created_at timestamp_ntz",
    "dim_drug": "drug_key bigint, drug_name string, created_at timestamp_ntz",
    "fact_admissions": "admission_key bigint, admission_id bigint, patient_id bigint, ward_id bigint, admission_time timestamp_ntz, created_at timestamp_ntz",
    "fact_labs": "lab_key bigint, patient_id bigint, sample_time timestamp_ntz, created_at timestamp_ntz",
    "fact_lab_turnaround": "lab_turnaround_key bigint, patient_id bigint, sample_time timestamp_ntz, completed_time timestamp_ntz, turnaround_minutes double, created_at timestamp_ntz",
    "fact_pharmacy": "inventory_key bigint, drug_name string, stock_on_hand int, reorder_level int, created_at timestamp_ntz",
    "fact_icu_alerts": "alert_id bigint, patient_id bigint, alert_time timestamp_ntz, alert_type string, severity string, created_at timestamp_ntz",
    "patient_summary": "patient_key bigint, patient_id bigint, first_name string, last_name string, age int, gender string, total_admissions bigint, created_at timestamp_ntz",
    "daily_admissions_summary": "admission_date string, daily_admissions bigint, unique_patients bigint, active_wards bigint",
}


def check_contract(df: DataFrame, contract: str) -> list[str]:
    """Mismatches between ``df`` and a contract (name or DDL string)."""
    ddl = GOLD_CONTRACTS.get(contract, contract)
    want = _parse_datatype_string(ddl)
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in want.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    return problems
