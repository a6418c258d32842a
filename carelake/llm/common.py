"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n``; -1 for a null id, which so belongs to no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared scratch folder: it cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_LARGE: dict[str, Callable[[], None]] = {}  # what this process holds that is large, and how to let it go


def hold_alone(name: str, drop: Callable[[], None]) -> None:
    """Say that this process is to hold something large, which ``drop`` lets go.  What it held under other names goes: worker processes
    outlive the queries and stages that they serve, and would keep what each of them needed."""
    if name not in _LARGE:
        for other in list(_LARGE):
            _LARGE.pop(other)()
        _LARGE[name] = drop


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the Arrow batches handed to Python, as whole documents may be long, and let workers that start from
    another folder find this package (on a cluster it is installed or sent with ``--py-files``)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
