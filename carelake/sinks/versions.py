"""Publication by manifest: data first, the name last.

Data goes to folders that no manifest names yet.  A new version exists once its manifest, one small file, is written;
until then, and if the writer fails before, readers keep the version before.  One manifest may name several tables, which so change
together.  There is one writer at a time: two that make the same version collide on its folder, and the second fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import list_files


def _folders(spark: SparkSession, folder: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


class Versions:
    """The versions under ``root``; a manifest is any JSON object."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def committed(self) -> list[int]:
        return [int(v) for v in _folders(self.spark, f"{self.root}/_manifest") if v.isdigit() and list_files(self.spark, f"{self.root}/_manifest/{v}")]

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version (the last committed one); None if there is none."""
        if version is None:
            known = self.committed()
            if not known:
                return None
            version = known[-1]
        return json.loads(self.spark.read.text(f"{self.root}/_manifest/{version:012d}", wholetext=True).first()[0])

    def next(self) -> int:
        known = _folders(self.spark, f"{self.root}/_manifest")
        return int(known[-1]) + 1 if known else 1

    def data_folder(self, version: int) -> str:
        """A new folder for data of a version; a retry after a failure gets another one."""
        return f"data/{version:012d}-{uuid.uuid4().hex[:8]}"

    def commit(self, version: int, manifest: dict) -> int:
        row = self.spark.createDataFrame([(json.dumps(manifest),)], "manifest string")
        row.coalesce(1).write.text(f"{self.root}/_manifest/{version:012d}")
        return version

    def publish(self, tables: dict[str, DataFrame]) -> int:
        """Write each table and switch all their names at once; names that are not given keep their data."""
        version, before = self.next(), self.manifest() or {}
        placed, by_plan = dict(before.get("tables", {})), {}
        for name, df in tables.items():
            if id(df) not in by_plan:  # one table under several names is computed and written once
                by_plan[id(df)] = f"{self.data_folder(version)}"
                df.write.parquet(f"{self.root}/{by_plan[id(df)]}")
            placed[name] = by_plan[id(df)]
        return self.commit(version, before | {"tables": placed})

    def table(self, name: str, version: int | None = None) -> DataFrame:
        found = self.manifest(version)
        if not found or name not in found.get("tables", {}):
            raise LookupError(f"no committed version of {name} under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{found['tables'][name]}")

    def clean(self, keep: int = 2) -> list[str]:
        """Delete data folders that none of the last ``keep`` committed versions names; gives their names.

        Folders of a version that is still being written have a number above the last committed one and stay.
        """
        known = self.committed()
        if not known:
            return []
        used = json.dumps([self.manifest(v) for v in known[-keep:]])
        jvm = self.spark.sparkContext._jvm
        gone = []
        for name in _folders(self.spark, f"{self.root}/data"):
            if int(name.split("-")[0]) <= known[-1] and f"data/{name}" not in used:
                p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/{name}")
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
                gone.append(name)
        return gone
