"""Latest-wins tables kept up to date by buckets (SRC-04, AGG-21).

A table of one row per key is kept in buckets of the key's hash.  A merge reduces the new snapshot rows to one per key, looks
into the buckets they fall in, and rewrites only those in which a row really changes; the others stay files of earlier
versions.  The manifest (:mod:`.versions`) names each bucket's files and is committed last.  Deleted keys stay as
marked rows, so that a snapshot that comes late cannot bring them back.  The result is that of ``latest_per_key`` over
all snapshots ever merged, in any order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import latest_per_key
from ..operators.ranges import written
from .versions import Versions

DELETED, BUCKET = "_deleted", "_bucket"


@dataclass(frozen=True)
class Merged:
    """What a merge did: the version (the old one if nothing changed), rewritten buckets, and new rows without a key."""

    version: int
    rewritten: tuple[int, ...]
    keyless: bool


class BucketedTable:
    """One row per ``keys``, the greatest by ``order`` (then by the other columns), in ``buckets`` buckets under ``root``.

    Rows with a null in a key are no duplicates of each other: each merge appends them.  ``buckets`` is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> None:
        self.spark, self.keys, self.order = spark, list(keys), list(order)
        self.versions = Versions(spark, root)
        found = self.versions.manifest()
        self.buckets = found["buckets"] if found else buckets

    def _read(self, manifest: dict, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.versions.root}/{f}" for f in folders])

    def read(self, version: int | None = None, deleted: bool = False) -> DataFrame:
        """The table; with ``deleted`` also the rows that mark deleted keys, and the mark."""
        found = self.versions.manifest(version)
        if found is None:
            raise LookupError(f"nothing is merged yet under {self.versions.root}")
        rows = self._read(found, [*found["keyed"].values(), *found["keyless"]])
        return rows if deleted else rows.filter(~F.col(DELETED)).drop(DELETED)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def merge(self, changes: DataFrame, deleted: Column | None = None) -> Merged:
        """Merge snapshot rows; those for which ``deleted`` holds take their key out as of their order.

        Columns that the table lacks are added (null in older rows), those that the changes lack are null in them.
        """
        new = changes.withColumn(DELETED, F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
        found = self.versions.manifest()
        if found:
            empty = self.spark.createDataFrame([], T.StructType.fromJson(found["schema"]))
            new = empty.unionByName(new, allowMissingColumns=True)
        else:
            found = {"buckets": self.buckets, "keyed": {}, "keyless": []}
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in new.schema.fields])  # everything may be null
        found["schema"] = schema.jsonValue()
        has_key = F.lit(True)
        for k in self.keys:
            has_key = has_key & F.col(k).isNotNull()
        reduced = written(latest_per_key(new.filter(has_key), self.keys, self.order).withColumn(BUCKET, self._bucket()), "merge-changes")
        touched = sorted(r[0] for r in reduced.select(BUCKET).distinct().collect())  # ``buckets`` rows at most
        state = self._read(found, [found["keyed"][str(b)] for b in touched if str(b) in found["keyed"]])
        changed = self._changed(reduced, state, schema)
        version = self.versions.next()
        keyless = new.filter(~has_key)
        has_keyless = bool(keyless.limit(1).count())
        if not changed and not has_keyless:
            return Merged(version - 1, (), False)
        if changed:
            folder = self.versions.data_folder(version)
            old = self._read(found, [found["keyed"][str(b)] for b in changed if str(b) in found["keyed"]])
            both = old.unionByName(reduced.filter(F.col(BUCKET).isin(changed)).drop(BUCKET).select(*schema.names))
            merged = latest_per_key(both, self.keys, self.order).withColumn(BUCKET, self._bucket())
            merged.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.versions.root}/{folder}")
            found["keyed"].update({str(b): f"{folder}/{BUCKET}={b}" for b in changed})
        if has_keyless:
            folder = self.versions.data_folder(version)
            keyless.select(*schema.names).write.parquet(f"{self.versions.root}/{folder}")
            found["keyless"].append(folder)
        return Merged(self.versions.commit(version, found), tuple(changed), has_keyless)

    def _changed(self, reduced: DataFrame, state: DataFrame, schema: T.StructType) -> list[int]:
        """Buckets in which a new row wins over the kept one, or its key is new."""
        payload = [*self.order, *[c for c in schema.names if c not in self.keys and c not in self.order]]
        rank = F.struct(*[F.col(c) for c in payload])
        kept = state.select(*self.keys, rank.alias("_old"))
        new = reduced.select(*self.keys, BUCKET, rank.alias("_new"))
        wins = new.join(kept, self.keys, "left").filter(F.col("_old").isNull() | (F.col("_new") > F.col("_old")))
        return sorted(r[0] for r in wins.select(BUCKET).distinct().collect())
