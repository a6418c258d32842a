"""Suite results, pass rules, quality score and run roll-up (VS-05, VS-07,
VS-09, VS-10, VS-18, VS-19, VS-20).

A result is a one-row DataFrame with an explicit schema (so a clean table's
result with empty lists can be saved, G8).  It is computed from the check
rows of a suite (a handful of rows, the row count among them); nothing is
collected to the driver.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..operators import profile

RESULT_SCHEMA = (
    "table_name string, validation_time timestamp_ntz, row_count bigint, issues array<string>, "
    "warnings array<string>, issue_count int, warning_count int, passed boolean, quality_score double"
)


def suite_result(
    checks: DataFrame,
    table: DataFrame | None,
    table_name: str,
    as_of: datetime,
    rule: str = "records",
    issue_ratio: float = 0.05,
    expired_tolerance: float = 0,
) -> DataFrame:
    """Fold check rows into one result row.

    The row count is read from the suite's ``row_count`` row, so the table
    is not scanned again (``table`` is accepted for symmetry only).  Rule ``records`` (VS-05): passed when there is no issue; an extra issue is
    added when issues / rows exceeds the ratio.  ``pharmacy`` (VS-07): with
    issues, fail when issues / rows exceeds the ratio or expired / rows
    exceeds the tolerance / 100.  ``labs`` (VS-10): fail when issues / rows
    exceeds the ratio.  ``plain``: passed when there is no issue, and no
    message of its own.  A missing required column or an empty table fails under every rule.  The quality score (VS-09) is reported for all.
    """
    fired = F.col("fired")
    # one aggregate over the check rows; the suite's own aggregate already
    # counted the table rows, so the table is not scanned again
    one = checks.agg(
        F.sort_array(F.collect_list(F.when(fired & (F.col("severity") == "issue"), F.col("message")))).alias("issues"),
        F.sort_array(F.collect_list(F.when(fired & (F.col("severity") == "warning"), F.col("message")))).alias("warnings"),
        F.coalesce(F.sum(F.when(F.col("check") == "expired", F.col("failed"))), F.lit(0)).alias("expired"),
        F.coalesce(F.max(F.when(F.col("check") == "row_count", F.col("failed"))), F.lit(0)).alias("row_count"),
        F.coalesce(F.max(fired & F.col("check").isin("missing_columns", "empty")), F.lit(False)).alias("halted"),
    )
    n_issues = F.size("issues")
    ratio = n_issues / F.greatest(F.col("row_count"), F.lit(1))
    if rule == "records":
        exceeded = (F.col("row_count") > 0) & (n_issues / F.col("row_count") > issue_ratio)
        extra = F.format_string(
            "Issue ratio (%.1f%%) exceeds threshold (%.1f%%)", n_issues / F.col("row_count") * 100, F.lit(issue_ratio * 100)
        )
        one = one.withColumn("issues", F.when(exceeded, F.concat("issues", F.array(extra))).otherwise(F.col("issues")))
        passed = (n_issues == 0) & ~F.coalesce(exceeded, F.lit(False))
        # size is re-read below after the extra message was appended
    elif rule == "pharmacy":
        passed = (n_issues == 0) | ~(
            (ratio > issue_ratio) | (F.col("expired") / F.greatest(F.col("row_count"), F.lit(1)) > expired_tolerance / 100)
        )
    elif rule == "plain":
        passed = n_issues == 0
    else:
        passed = (n_issues == 0) | ~(ratio > issue_ratio)
    # a suite that could not look at its rows never passes, whatever the ratio
    one = one.withColumn("passed", passed & ~F.col("halted"))
    n_i, n_w = F.size("issues"), F.size("warnings")
    score = F.when(F.col("row_count") == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - F.least(F.lit(50.0), n_i * 10.0) - F.least(F.lit(20.0), n_w * 2.0)))
    )
    return one.select(
        F.lit(table_name).alias("table_name"),
        ts_lit(as_of).alias("validation_time"),
        F.col("row_count").cast("bigint"),
        "issues",
        "warnings",
        n_i.alias("issue_count"),
        n_w.alias("warning_count"),
        "passed",
        score.cast("double").alias("quality_score"),
    )


def guarded(build, table_name: str, spark, as_of: datetime) -> DataFrame:
    """VS-20: a validator that fails becomes a failed result with the message.

    The result is one row; it is computed here, so that what fails only when
    Spark runs the checks is caught as well.
    """
    try:
        return spark.createDataFrame(build().collect(), RESULT_SCHEMA)
    except Exception as e:  # noqa: BLE001 - reported, not swallowed
        return spark.createDataFrame(
            [(table_name, as_of, 0, [f"Validation error: {e}"], [], 1, 0, False, 0.0)], RESULT_SCHEMA
        )


def rollup(results: list[DataFrame]) -> DataFrame:
    """VS-19: all passed? and the sorted list of failed tables."""
    allr = results[0]
    for r in results[1:]:
        allr = allr.unionByName(r)
    return allr.agg(
        F.coalesce(F.min(F.col("passed").cast("int")) == 1, F.lit(True)).alias("all_passed"),
        F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("table_name")))).alias("failed_tables"),
        F.count(F.lit(1)).alias("tables_checked"),
    )


def referential_integrity(fact: DataFrame, dim_patient: DataFrame, dim_ward: DataFrame) -> DataFrame:
    """VS-18 / JN-06: missing patient and ward references, PASS/FAIL each and overall."""
    parts = []
    for name, dim, key in (
        ("fact_admissions_patient_integrity", dim_patient, "patient_id"),
        ("fact_admissions_ward_integrity", dim_ward, "ward_id"),
    ):
        if key in fact.columns and key in dim.columns:
            miss = profile.missing_references(fact, dim, key).agg(F.count(F.lit(1)).alias("missing"))
            parts.append(miss.select(F.lit(name).alias("check"), F.col("missing").cast("bigint").alias("missing")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("status", F.when(F.col("missing") == 0, "PASS").otherwise("FAIL"))
    # a window over the (two) check rows, not over data rows
    any_fail = F.max((F.col("status") == "FAIL").cast("int")).over(Window.partitionBy())
    return out.withColumn("overall_status", F.when(any_fail == 1, "FAIL").otherwise("PASS"))
