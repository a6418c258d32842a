"""Check specifications and their compilation into few Spark aggregations.

A suite is a list of checks.  Row checks (a predicate per row) compile into
*one* aggregate over the table — one scan, whatever the number of checks.
Keyed checks (duplicates, rare values, per-class statistics, intervals) each
add one grouped pass.  Every check yields one row

    suite, check, severity, failed, fired, message

so that a suite's output is a small DataFrame whose size depends on the
number of checks, never on the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISSUE = "issue"
WARNING = "warning"

RESULT_COLUMNS = ["suite", "check", "severity", "failed", "fired", "message"]


@dataclass(frozen=True)
class RowCheck:
    """Counts rows where ``predicate`` is true; fires when the count exceeds ``tolerance``.

    ``message`` is a ``format_string`` pattern receiving the count (``%d``).
    """

    name: str
    severity: str
    predicate: Column
    message: str
    tolerance: int = 0


def _finish(df: DataFrame, suite: str) -> DataFrame:
    return df.select(
        F.lit(suite).alias("suite"),
        F.col("check"),
        F.col("severity"),
        F.col("failed").cast("bigint").alias("failed"),
        F.col("fired"),
        F.when(F.col("fired"), F.col("message")).alias("message"),
    )


ROW_COUNT = "row_count"
METRIC = "metric"
NEVER = 2**62


def run_row_checks(
    df: DataFrame, suite: str, checks: list[RowCheck], empty_message: str | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """All row checks of a suite in one aggregate (one scan of ``df``).

    The same aggregate also yields the ``row_count`` metric row and, when
    ``empty_message`` is given, the ``empty`` check, so neither needs a scan
    of its own.  ``counts`` may supply the aggregate pre-computed (columns
    ``_n`` and ``_c<i>``), e.g. summed from a grouped pass.
    """
    if counts is None:
        counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c.predicate).alias(f"_c{i}") for i, c in enumerate(checks)])
    agg = counts
    extra = [F.struct(F.lit(ROW_COUNT).alias("check"), F.lit(METRIC).alias("severity"), F.col("_n").alias("failed"),
                      F.lit(False).alias("fired"), F.lit(None).cast("string").alias("message"))]
    if empty_message is not None:
        extra.append(F.struct(F.lit("empty").alias("check"), F.lit(ISSUE).alias("severity"), (F.col("_n") == 0).cast("bigint").alias("failed"),
                              (F.col("_n") == 0).alias("fired"), F.lit(empty_message).alias("message")))
    rows = F.array(
        *extra,
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.severity).alias("severity"),
                F.col(f"_c{i}").alias("failed"),
                (F.col(f"_c{i}") > c.tolerance).alias("fired"),
                F.format_string(c.message, F.col(f"_c{i}")).alias("message"),
            )
            for i, c in enumerate(checks)
        ],
    )
    return _finish(agg.select(F.inline(rows)), suite)


def metric_check(one_row: DataFrame, suite: str, name: str, severity: str, value: Column, message: Column, tolerance: int = 0) -> DataFrame:
    """A check whose count comes from a one-row aggregate."""
    out = one_row.select(
        F.lit(name).alias("check"),
        F.lit(severity).alias("severity"),
        value.alias("failed"),
        (value > tolerance).alias("fired"),
        message.alias("message"),
    )
    return _finish(out, suite)


def static_check(spark: SparkSession, suite: str, name: str, severity: str, failed: int, message: str) -> DataFrame:
    """A check decided from metadata alone (e.g. missing columns)."""
    df = spark.createDataFrame([(name, severity, failed, failed > 0, message)], "check string, severity string, failed bigint, fired boolean, message string")
    return _finish(df, suite)


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "suite string, check string, severity string, failed bigint, fired boolean, message string")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
