"""Laboratory reference ranges and first-match classification (FN-17, FN-20).

A test type belongs to the first range name (in the order below) that occurs
as a substring of its standardised name; later names never see rows already
claimed by an earlier one.  The classification is one ordered ``CASE``
expression, so every row is classified in a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import standardise

# Fixed values that must equal the reference: range name, min, max — in match order.
REFERENCE_RANGES: list[tuple[str, float, float]] = [
    ("glucose", 70.0, 140.0),
    ("cholesterol", 125.0, 200.0),
    ("hemoglobin", 13.5, 17.5),
    ("wbc", 4.5, 11.0),
    ("rbc", 4.7, 6.1),
    ("platelets", 150.0, 450.0),
    ("sodium", 135.0, 145.0),
    ("potassium", 3.5, 5.0),
    ("creatinine", 0.6, 1.2),
    ("alt", 7.0, 56.0),
    ("ast", 10.0, 40.0),
    ("bilirubin", 0.1, 1.2),
]

# Test families whose results must not be negative.
POSITIVE_ONLY_TESTS = ["glucose", "cholesterol", "hemoglobin", "wbc", "rbc", "platelets"]


def classify(test_type: Column | str) -> Column:
    """Range name of the first matching entry, NULL when none matches."""
    std = standardise(test_type)
    expr = None
    for name, _lo, _hi in REFERENCE_RANGES:
        cond = std.contains(name)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def range_table(spark: SparkSession) -> DataFrame:
    """The 12-row range table (fixed size; safe to broadcast)."""
    rows = [(i, n, lo, hi) for i, (n, lo, hi) in enumerate(REFERENCE_RANGES)]
    return spark.createDataFrame(rows, "match_order int, range_name string, range_min double, range_max double")


def must_be_positive(test_type: Column | str) -> Column:
    std = standardise(test_type)
    return F.coalesce(std.rlike("|".join(POSITIVE_ONLY_TESTS)), F.lit(False))
