from datetime import date, datetime

from pyspark.sql import functions as F

from carelake.functions import dates, keys, lab_ranges, parse, text


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_lenient_double_and_long(spark):
    vals = one(spark, parse.lenient_double("s"), [("12.5",), ("abc",), ("NaN",), (None,), (" 7 ",)], "s string")
    assert vals == [12.5, None, None, None, 7.0]
    assert one(spark, parse.lenient_long("s"), [("12.0",), ("x",)], "s string") == [12, None]


def test_lenient_timestamp(spark):
    vals = one(spark, parse.lenient_timestamp("s"), [("2024-01-05",), ("2024-01-05 10:11:12",), ("2025-11-23T15:03:36.237030",), ("n/a",), ("",)], "s string")
    assert vals[0] == datetime(2024, 1, 5)
    assert vals[1] == datetime(2024, 1, 5, 10, 11, 12)
    assert vals[2] == datetime(2025, 11, 23, 15, 3, 36, 237030)
    assert vals[3] is None and vals[4] is None


def test_calendar_age_not_birthday_aware(spark):
    vals = one(spark, dates.calendar_age("d", datetime(2025, 1, 1)), [(date(2024, 12, 31),), (None,)], "d date")
    assert vals == [1, None]


def test_shift_years_clips_leap_day():
    assert dates.shift_years(datetime(2024, 2, 29), 1) == datetime(2025, 2, 28)


def test_date_key(spark):
    assert one(spark, dates.date_key("t"), [(datetime(2024, 1, 5, 23, 59),)], "t timestamp_ntz") == [20240105]


def test_elapsed_minutes_truncates_fractions(spark):
    vals = one(
        spark,
        dates.elapsed_minutes("a", "b"),
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 2, 0, 1, 100000))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert vals == [120 + 1 / 60]


def test_first_match_classification(spark):
    data = [("Fasting Glucose",), ("fasting insulin",), ("ALT",), ("Renal Panel",), (None,), ("glucose wbc",)]
    vals = one(spark, lab_ranges.classify("t"), data, "t string")
    # 'fasting' contains 'ast', which matches when no earlier name does
    assert vals == ["glucose", "ast", "alt", None, None, "glucose"]


def test_positive_only_tests(spark):
    vals = one(spark, lab_ranges.must_be_positive("t"), [("WBC count",), ("Sodium",), (None,)], "t string")
    assert vals == [True, False, False]


def test_text_predicates(spark):
    data = [("abc_1",), ("a b",), (None,), ("12",), ("Jo#n",)]
    assert one(spark, text.has_valid_id_format("s"), data, "s string") == [True, False, None, True, False]
    assert one(spark, text.is_digits_only("s"), data, "s string") == [False, False, False, True, False]
    assert one(spark, text.has_unusual_chars("s"), data, "s string") == [True, False, False, True, True]
    assert one(spark, text.is_blank("s"), [(" ",), ("",), (None,), ("x",)], "s string") == [True, True, True, False]


def test_surrogate_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k long, s string")
    ks = [r[0] for r in df.select(keys.surrogate_key("k", "s")).collect()]
    assert ks[0] == ks[1] and ks[0] != ks[2] and all(k >= 0 for k in ks)
    again = [r[0] for r in df.repartition(3).select(keys.surrogate_key("k", "s")).collect()]
    assert sorted(ks) == sorted(again)
