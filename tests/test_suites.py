from datetime import datetime

from carelake.quality import results, suites

AS_OF = datetime(2025, 1, 1)


def by_check(df):
    return {r.check: r for r in df.collect()}


def test_patients_suite_edge_cases(spark):
    rows = [
        ("1", "Ann", "Lee", "1990-01-01"),
        ("1", " ", "O#Neil", "2025-01-02"),      # duplicate id, blank first name, '#', 1 day ahead
        (None, "Bo", "3rd", "2027-01-01"),        # NULL id, digit, 2 years ahead
        ("x y", "C", "D", "1800-01-01"),          # bad id format, very old
        ("5", "E", None, "garbage"),              # NULL last name, malformed date
    ]
    df = spark.createDataFrame(rows, "patient_id string, first_name string, last_name string, date_of_birth string")
    c = by_check(suites.validate_patients(df, AS_OF))
    assert c["pk_null"].failed == 1 and c["pk_duplicate"].failed == 1
    assert c["id_format"].failed == 1
    assert c["dob_invalid"].failed == 1
    assert c["dob_future_far"].failed == 1 and c["dob_future_near"].failed == 1
    assert c["dob_very_old"].failed == 1 and c["age_too_old"].failed == 1 and c["age_too_young"].failed == 2
    assert c["first_name_empty"].failed == 1 and c["last_name_empty"].failed == 1
    assert c["last_name_unusual"].failed == 2
    assert c["missing_columns"].fired is False
    assert c["pk_null"].message == "1 null values in primary key patient_id"


def test_missing_column_reported_but_records_suite_continues(spark):
    df = spark.createDataFrame([("1", "Ann")], "patient_id string, first_name string")
    c = by_check(suites.validate_patients(df, AS_OF))
    assert c["missing_columns"].message == "Missing required columns: ['last_name', 'date_of_birth']"
    assert "pk_null" in c


def test_wards_capacity_negative_counts_twice(spark):
    df = spark.createDataFrame([("1", "A", "-1"), ("2", "B", "0"), ("3", "C", "201"), ("4", "D", "50")], "ward_id string, ward_name string, capacity string")
    c = by_check(suites.validate_wards(df, AS_OF))
    assert c["capacity_negative"].failed == 1 and c["capacity_unrealistic"].failed == 3


def test_pharmacy_quantities_and_expiry(spark):
    rows = [
        ("1", "aspirin", "-1", "2025-01-10", "analgesic"),
        ("2", "b", "0", "2024-12-01", "antibiotic"),
        ("3", "123", "1001", "1999-01-01", "weird"),
        ("4", "", "10001", "2031-01-01", None),
        ("4", None, "abc", "bad", "vaccine"),
    ]
    df = spark.createDataFrame(rows, "drug_id string, drug_name string, quantity string, expiry_date string, category string")
    c = by_check(suites.validate_pharmacy(df, AS_OF))
    assert c["quantity_negative"].failed == 1 and c["quantity_zero"].failed == 1
    assert c["quantity_high"].failed == 2 and c["quantity_over_max"].failed == 1
    assert c["quantity_non_numeric"].failed == 1
    assert c["expired"].failed == 2 and c["expiry_before_2000"].failed == 1
    assert c["expiring_soon"].failed == 1 and c["expiry_far_future"].failed == 1 and c["expiry_invalid"].failed == 1
    assert c["pk_duplicate"].failed == 1 and c["null_drug_name"].failed == 1
    assert c["short_drug_name"].failed == 2 and c["numeric_drug_name"].failed == 1 and c["empty_drug_name"].failed == 2
    assert c["category_unknown"].message == "Found unknown drug categories: ['weird']"
    assert c["category_missing"].failed == 1


def test_pharmacy_missing_column_stops_suite(spark):
    df = spark.createDataFrame([("1", "a")], "drug_id string, drug_name string")
    checks = {r.check for r in suites.validate_pharmacy(df, AS_OF).collect()}
    assert checks == {"empty", "missing_columns", "row_count"}


def test_labs_reference_range_messages(spark):
    rows = [("p%03d" % i, "Glucose", "2024-12-30 10:00:00", "300") for i in range(3)] + [("p999", "Glucose", "2024-12-30 11:00:00", "100")]
    df = spark.createDataFrame(rows, "patient_id string, test_type string, test_date string, result_value string")
    c = by_check(suites.validate_lab_results(df, AS_OF))
    assert c["abnormal_glucose"].severity == "issue"
    assert c["abnormal_glucose"].message == "glucose: 3 abnormal results (75.0%)"


def test_result_rules_and_quality_score(spark):
    df = spark.createDataFrame([("1", "a", "abc", "bad")], "drug_id string, drug_name string, quantity string, expiry_date string")
    checks = suites.validate_pharmacy(df, AS_OF)
    r = results.suite_result(checks, df, "pharmacy", AS_OF, "pharmacy", 0.01, 0).collect()[0]
    assert r.issue_count == 2 and r.passed is False
    assert r.quality_score == 100 - 20 - min(20, 2 * r.warning_count)
    empty = spark.createDataFrame([], "drug_id string, drug_name string, quantity string, expiry_date string")
    e = results.suite_result(suites.validate_pharmacy(empty, AS_OF), empty, "pharmacy", AS_OF, "pharmacy").collect()[0]
    assert e.issues == ["Drug inventory data is empty"] and e.quality_score == 0.0


def test_records_ratio_rule_adds_issue(spark):
    df = spark.createDataFrame([(None, "a", "b", "2000-01-01")], "patient_id string, first_name string, last_name string, date_of_birth string")
    r = results.suite_result(suites.validate_patients(df, AS_OF), df, "patients", AS_OF).collect()[0]
    assert any(m.startswith("Issue ratio (") for m in r.issues) and r.passed is False


def test_guarded_validator_reports_error(spark):
    def boom():
        raise ValueError("no table")

    r = results.guarded(boom, "x", spark, AS_OF).collect()[0]
    assert r.passed is False and r.issues == ["Validation error: no table"]


def test_rollup(spark):
    a = spark.createDataFrame([("a", AS_OF, 1, [], [], 0, 0, True, 100.0)], results.RESULT_SCHEMA)
    b = spark.createDataFrame([("b", AS_OF, 1, ["x"], [], 1, 0, False, 90.0)], results.RESULT_SCHEMA)
    r = results.rollup([a, b]).collect()[0]
    assert r.all_passed is False and r.failed_tables == ["b"]


def test_row_checks_are_one_scan(spark):
    df = spark.createDataFrame([("1", "a", "b", "2000-01-01")], "patient_id string, first_name string, last_name string, date_of_birth string")
    from carelake.quality.checks import run_row_checks
    from carelake.quality.suites import RowCheck
    from pyspark.sql import functions as F

    checks = [RowCheck(f"c{i}", "issue", F.col("patient_id") == str(i), "%d") for i in range(20)]
    plan = run_row_checks(df, "s", checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("FileScan") == 1
