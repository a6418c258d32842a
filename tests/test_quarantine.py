"""Quarantine, identifiers and date forms on literal rows."""

from datetime import datetime

from pyspark.sql import functions as F

from carelake.functions.parse import canonical_id, date_form, lenient_timestamp
from carelake.operators import conditioning, quarantine


def test_every_row_is_on_one_side_with_its_reasons(spark, tmp_path):
    rows = [
        ("1", "P-7", "Glucose", "2024-01-05", "5.1"), (None, "7", "Glucose", "2024/01/05", "5.1"), ("2", " ", " ", "tbd", "positive"),
        ("3", "8", "ALT", None, None), ("3", "8", "ALT", None, None), ("4", "9", "ALT", "", ""),
    ]
    df = spark.createDataFrame(rows, "lab_result_id string, patient_id string, test_type string, test_date string, result_value string")
    got = quarantine.route(df, quarantine.lab_rules(), str(tmp_path / "q"))
    assert got.accepted.columns == df.columns
    assert sorted(r.lab_result_id for r in got.accepted.collect()) == ["1", "3", "3", "4"]
    out = {r.lab_result_id: r.reject_reasons for r in got.rejected.collect()}
    assert out == {None: ["no_result_id"], "2": ["no_patient", "no_test", "bad_test_date", "bad_result"]}
    assert {r.reason: r.rows for r in got.summary().collect()} == {"no_result_id": 1, "no_patient": 1, "no_test": 1, "bad_test_date": 1, "bad_result": 1}
    both = got.accepted.unionAll(got.rejected.drop("reject_reasons"))
    assert sorted(map(str, both.collect())) == sorted(map(str, df.collect()))


def test_sides_without_rows(spark, tmp_path):
    schema = "lab_result_id string, patient_id string, test_type string, test_date string, result_value string"
    clean = quarantine.route(spark.createDataFrame([("1", "2", "ALT", None, None)], schema), quarantine.lab_rules(), str(tmp_path / "a"))
    assert clean.accepted.count() == 1 and clean.rejected.count() == 0
    none = quarantine.route(spark.createDataFrame([], schema), quarantine.lab_rules(), str(tmp_path / "b"))
    assert none.accepted.count() == 0 and none.rejected.count() == 0


def test_identifiers_stay(spark):
    given = ["12", " 12 ", "012", "12.0", "P-12", " D-001", "", "  ", None, "9007199254740993", "1e3x"]
    df = spark.createDataFrame([(x,) for x in given], "x string")
    assert [r[0] for r in df.select(canonical_id("x")).collect()] == ["12", "12", "12", "12", "P-12", "D-001", None, None, None, "9007199254740993", "1e3x"]
    labs = spark.createDataFrame([("5", "P#9", "2024-01-01 10:00:00")], "lab_result_id string, patient_id string, collected_time string")
    assert conditioning.silver_lab_results(labs, datetime(2024, 2, 1)).first().patient_id == "P#9"
    typed = spark.createDataFrame([(5, 9, "2024-01-01 10:00:00")], "lab_result_id long, patient_id long, collected_time string")
    assert conditioning.silver_lab_results(typed, datetime(2024, 2, 1)).first().patient_id == 9


def test_date_forms(spark):
    given = {
        "2024-01-05": "iso", "2024-01-05 10:11:12": "iso", "2024-01-05T10:11:12": "iso", "2024/01/05": "yyyy/MM/dd", "2024/01/05 10:11:12": "yyyy/MM/dd HH:mm:ss",
        "05 Jan 2024": "dd MMM yyyy", "20240105": "yyyyMMdd", "": "blank", "tbd": "unknown", "2024/13/05": "unknown", "20241305": "unknown",
    }
    df = spark.createDataFrame([(x,) for x in given], "x string")
    got = {r[0]: (r[1], r[2]) for r in df.select("x", date_form("x"), lenient_timestamp("x")).collect()}
    assert {x: f for x, (f, _) in got.items()} == given
    for x, (form, at) in got.items():
        assert (at is None) == (form in ("blank", "unknown"))
        if at is not None:
            assert at.date() == datetime(2024, 1, 5).date() and (at.hour == 10) == ("10:11" in x)
    # one pass tells which forms a column holds
    votes = {r[0]: r[1] for r in df.groupBy(date_form("x")).agg(F.count(F.lit(1))).collect()}
    assert votes["iso"] == 3 and votes["unknown"] == 3
