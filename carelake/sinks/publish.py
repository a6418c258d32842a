"""Publication (SNK-01..08).

Row counts are taken with an ``Observation`` while the data is written, so
no table is scanned a second time to report its size.  Writes target
fresh directories or single partitions, so a re-run after a lost executor or
a failed job rewrites the same output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .contracts import check_contract

# Null marker of landed CSV files, so that NULL and the empty string stay distinct.
CSV_NULL = "\\N"
CSV_WRITE_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": CSV_NULL}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: list[str] | None = None) -> int:
    """SNK-01: write and return the row count observed during the write."""
    obs = Observation(f"rows_{uuid.uuid4().hex}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


def land_snapshot(df: DataFrame, table_root: str, run_id: str | None, fmt: str = "csv") -> int:
    """SNK-02: write one run under ``dt=<run_id>``; only that partition is replaced.

    With ``run_id=None`` the frame's own ``dt`` column names the snapshots.
    """
    obs = Observation(f"land_{uuid.uuid4().hex}")
    out = (df if run_id is None else df.withColumn("dt", F.lit(run_id))).observe(obs, F.count(F.lit(1)).alias("rows"))
    # per-write option: only the partitions present in this write are replaced
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").format(fmt)
    if fmt == "csv":
        w = w.options(**CSV_WRITE_OPTIONS)
    w.save(table_root)
    return int(obs.get["rows"])


def dated_path(root: str, table: str, when: datetime) -> str:
    """SNK-02: ``<root>/<table>/yyyy/mm/dd`` landing folder."""
    return f"{root.rstrip('/')}/{table}/{when:%Y/%m/%d}"


def write_with_fallback(df: DataFrame, primary: str, fallback: str, fmt: str = "parquet") -> str:
    """SNK-03: write to ``primary``; on failure to ``fallback``; return the path used."""
    try:
        write_table(df, primary, fmt=fmt)
        return primary
    except Exception:  # noqa: BLE001 - the fallback is the documented behaviour
        write_table(df, fallback, fmt=fmt)
        return fallback


def append_validation_result(result: DataFrame, root: str, layer: str, run_date: str, table: str) -> str:
    """SNK-04: append a result row as JSON under ``<layer>/validation/<date>/``."""
    path = f"{root.rstrip('/')}/{layer}/validation/{run_date}/{table}_validation"
    result.coalesce(1).write.mode("append").json(path)
    return path


def register_external_table(spark: SparkSession, name: str, path: str, contract: str | None = None) -> list[str]:
    """SNK-05: catalog table over a Parquet directory; returns contract mismatches."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{path}'")
    return check_contract(spark.table(name), contract) if contract else []


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """SNK-06: named (temporary) view for SQL users."""
    df.createOrReplaceTempView(name)
    return df


def publish_twice(df: DataFrame, first: str, second: str) -> tuple[int, int]:
    """SNK-07: compute once, publish under two names.

    The second copy is written from the first copy's files, so the plan runs
    once and both names hold identical data.
    """
    n1 = write_table(df, first)
    n2 = write_table(df.sparkSession.read.parquet(first), second)
    return n1, n2


def build_tables(
    spark: SparkSession,
    builders: dict[str, Callable[[], DataFrame | None]],
    root: str,
    parallelism: int = 4,
) -> DataFrame:
    """SNK-08: build each table in isolation; one failure does not stop the rest.

    Independent tables are written as concurrent Spark jobs (``parallelism``
    driver threads), so many small tables do not leave the cluster idle.
    Returns ``(table, rows, status, error)`` in builder order — status
    ``ok``, ``skipped`` (builder returned None) or ``failed`` — so the caller
    sees failures instead of them being only logged.
    """
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        name, build = item
        try:
            df = build()
            if df is None:
                return (name, None, "skipped", None)
            return (name, write_table(df, f"{root.rstrip('/')}/{name}"), "ok", None)
        except Exception as e:  # noqa: BLE001 - reported per table
            return (name, None, "failed", f"{type(e).__name__}: {e}")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        report = list(pool.map(one, builders.items()))
    return spark.createDataFrame(report, "table string, rows bigint, status string, error string")
