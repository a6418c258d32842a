"""Surrogate keys from a registry (PRJ-12): dense numbers that never collide and never change.

A registry keeps one number for each natural key it has met.  Registering keys leaves the known ones as they are and
numbers the new ones on from the highest: they are dealt out in ranges of the key, counted part by part, and each part starts
where those before it end, so no task sees them all and the numbers are the ranks of the sorted new keys however many
parts there are.  New rows are new files; the version that names them is committed last, so a run that fails leaves no
numbers behind and a repeated run gives the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.versions import Versions
from .ranges import written

NUMBER, PART = "key_number", "_part"


class KeyRegistry:
    """Numbers from 1 for the distinct values of ``keys``, kept under ``root``.  Nulls are values like any other."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]) -> None:
        self.spark, self.keys, self.versions = spark, list(keys), Versions(spark, root)

    def numbers(self, version: int | None = None) -> DataFrame | None:
        """``keys, key_number`` of all registered keys; None before the first registration."""
        found = self.versions.manifest(version)
        if found is None:
            return None
        return self.spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(*[f"{self.versions.root}/{f}" for f in found["folders"]])

    def register(self, rows: DataFrame) -> int:
        """Number the keys of ``rows`` that have none yet; gives how many these are."""
        found = self.versions.manifest() or {"folders": [], "last": 0}
        new = rows.select(*self.keys).distinct()
        known = self.numbers()
        if known is not None:
            new = new.join(known, [new[k].eqNullSafe(known[k]) for k in self.keys], "left_anti")
        ranged = new.repartitionByRange(*[F.col(k).asc_nulls_first() for k in self.keys]).withColumn(PART, F.spark_partition_id())
        ranged = written(ranged, "new-keys")
        sizes = ranged.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))  # a row for each part
        before = F.coalesce(F.sum("n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = sizes.select(PART, (before + F.lit(found["last"])).alias("_before"))
        count = sizes.agg(F.sum("n")).first()[0] or 0
        if not count:
            return 0
        rank = F.row_number().over(Window.partitionBy(PART).orderBy(*[F.col(k).asc_nulls_first() for k in self.keys]))
        numbered = ranged.withColumn("_rank", rank).join(F.broadcast(offsets), PART)
        numbered = numbered.select(*self.keys, (F.col("_before") + F.col("_rank")).cast("long").alias(NUMBER))
        version = self.versions.next()
        folder = self.versions.data_folder(version)
        numbered.write.parquet(f"{self.versions.root}/{folder}")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in numbered.schema.fields])
        self.versions.commit(version, {"folders": [*found["folders"], folder], "last": found["last"] + count, "schema": schema.jsonValue()})
        return count

    def attach(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the number of their key as ``name``; null for keys that are not registered."""
        known = self.numbers()
        if known is None:
            return rows.withColumn(name, F.lit(None).cast("long"))
        joined = rows.join(known, [rows[k].eqNullSafe(known[k]) for k in self.keys], "left")
        return joined.select(*[rows[c] for c in rows.columns], known[NUMBER].alias(name))
