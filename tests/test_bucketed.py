"""Bucketed merges against a full rebuild, and versions under failures."""

import os
import random

import pytest
from pyspark.sql import functions as F

from carelake.operators.dedupe import latest_per_key
from carelake.sinks.bucketed import BucketedTable
from carelake.sinks.versions import Versions

SCHEMA = "id long, dt string, name string, gone boolean"


def snapshot(rng, dt, n, keys=400):
    return [(rng.choice([None, rng.randint(1, keys), 7]), dt, rng.choice([None, "a", "b"]), rng.random() < 0.1) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def rebuilt(spark, batches):
    whole = spark.createDataFrame([r for b in batches for r in b], SCHEMA).withColumn("_deleted", F.col("gone"))
    keyed, keyless = whole.filter("id is not null"), whole.filter("id is null")
    return rows(latest_per_key(keyed, ["id"], ["dt"]).unionByName(keyless).filter("not _deleted").drop("_deleted"))


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(os.path.join(root, "data")) for f in names if f.endswith(".parquet")}


def test_merges_equal_a_rebuild_in_any_order(spark, tmp_path):
    rng = random.Random(1)
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["dt"], buckets=8)
    batches = []
    for dt in ("2024-01-01", "2024-03-01", "2024-02-01", "2024-03-01", "2023-12-01"):  # late and repeated snapshots
        batches.append(snapshot(rng, dt, 300))
        table.merge(spark.createDataFrame(batches[-1], SCHEMA), deleted=F.col("gone"))
        assert rows(table.read()) == rebuilt(spark, batches)


def test_only_changed_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "t")
    table = BucketedTable(spark, root, ["id"], ["dt"], buckets=16)
    table.merge(spark.createDataFrame([(i, "2024-01-05", "a", False) for i in range(2000)], SCHEMA))
    before = files(root)
    assert len(before) == 16
    one = table.merge(spark.createDataFrame([(5, "2024-01-06", "new", False)], SCHEMA))
    assert len(one.rewritten) == 1 and len(files(root) - before) == 1 and before <= files(root)
    assert table.read().filter("name = 'new'").count() == 1 and table.read().count() == 2000
    # a late snapshot that loses everywhere, and one that was merged before, write nothing
    after = files(root)
    assert table.merge(spark.createDataFrame([(i, "2024-01-01", "z", False) for i in range(500)], SCHEMA)).rewritten == ()
    assert table.merge(spark.createDataFrame([(5, "2024-01-06", "new", False)], SCHEMA)).version == one.version
    assert files(root) == after


def test_a_deletion_outlives_late_rows(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["dt"], buckets=4)
    table.merge(spark.createDataFrame([(1, "2024-01-01", "a", False), (2, "2024-01-01", "a", False)], SCHEMA))
    table.merge(spark.createDataFrame([(1, "2024-01-10", None, True)], SCHEMA), deleted=F.col("gone"))
    table.merge(spark.createDataFrame([(1, "2024-01-05", "late", False)], SCHEMA))
    assert [r.id for r in table.read().collect()] == [2]
    table.merge(spark.createDataFrame([(1, "2024-01-11", "back", False)], SCHEMA))
    assert {r.id: r.name for r in table.read().collect()} == {1: "back", 2: "a"}
    assert table.read(version=1).count() == 2


def test_new_columns_and_empty_changes(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["id"], ["dt"], buckets=4)
    with pytest.raises(LookupError):
        table.read()
    table.merge(spark.createDataFrame([(1, "2024-01-01", "a", False)], SCHEMA))
    assert table.merge(spark.createDataFrame([], SCHEMA)).rewritten == ()
    table.merge(spark.createDataFrame([(2, "2024-01-02", 5)], "id long, dt string, extra int"))
    assert rows(table.read()) == [(1, "2024-01-01", "a", False, None), (2, "2024-01-02", None, None, 5)]


def test_a_failure_before_the_manifest_keeps_the_old_version(spark, tmp_path, monkeypatch):
    v = Versions(spark, str(tmp_path / "v"))
    with pytest.raises(LookupError):
        v.table("a")
    old = spark.range(3).toDF("x")
    v.publish({"a": old, "b": old})
    assert v.manifest()["tables"]["a"] == v.manifest()["tables"]["b"]  # written once
    bad = spark.range(5).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="lost"):
        v.publish({"a": spark.range(9).toDF("x"), "b": bad})  # the first table is written, the second fails
    assert [v.table(n).count() for n in "ab"] == [3, 3]
    with monkeypatch.context() as m:
        m.setattr(v, "commit", lambda *a: (_ for _ in ()).throw(OSError("no manifest")))
        with pytest.raises(OSError):
            v.publish({"a": spark.range(9).toDF("x")})
    assert v.table("a").count() == 3
    v.publish({"a": spark.range(4).toDF("x")})
    assert [v.table(n).count() for n in "ab"] == [4, 3]
    assert len(v.clean(keep=1)) >= 2 and [v.table(n).count() for n in "ab"] == [4, 3]
