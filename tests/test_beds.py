"""Beds against a queue walked event by event, and running values against plain windows."""

from collections import defaultdict, deque
from datetime import datetime, timedelta
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake.operators import beds, ranges

DAY0 = datetime(2024, 1, 1)


def walked(stays):
    """Bed of each stay by definition: the bed that has been free longest, a new one if none is."""
    found = {}
    for ward in {w for _, w, _, _ in stays}:
        events = sorted((t, kind, i) for i, w, s, e in stays if w == ward for t, kind in ((s, 1), (e, 2 if s == e else 0)))
        free, used = deque(), 0
        for _, kind, i in events:
            if kind == 1:
                if not free:
                    used += 1
                    free.append(used)
                found[i] = free.popleft()
            else:
                free.append(found[i])
    return found


def made(n, seed=5, hot=0.6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = DAY0 + timedelta(hours=rng.randint(0, 900))
        e = s + timedelta(hours=rng.choice([0, 0, 1, 5, 30, 200]), minutes=rng.choice([0, 0, 30]))
        rows.append((i, None if i % 50 == 7 else 1 if rng.random() < hot else rng.randint(2, 4), s, e))
    return rows


@pytest.fixture(scope="module")
def given(spark):
    rows = made(900)
    df = spark.createDataFrame(rows, "admission_id long, ward_id long, start timestamp_ntz, end timestamp_ntz").repartition(6)
    return rows, ranges.written(beds.assign_beds(df), "test-beds")


def test_beds_follow_the_queue(given):
    rows, got = given
    assert {r.admission_id: r.bed for r in got.collect()} == walked(rows)


def test_no_bed_is_taken_twice_and_none_is_spare(given):
    rows, got = given
    by_bed, by_ward = defaultdict(list), defaultdict(list)
    for r in got.collect():
        by_bed[r.ward_id, r.bed].append((r.start, r.end))
        by_ward[r.ward_id].append((r.start, r.end, r.bed))
    for own in by_bed.values():
        own.sort()
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))
    for own in by_ward.values():
        times = sorted({s for s, _, _ in own})
        # at an instant a stay without length is on its bed together with those that begin then
        most = max(sum(1 for s, e, _ in own if s <= t and (e > t or s == e == t)) for t in times)
        assert max(b for _, _, b in own) == most


def test_bed_days_add_up(spark, given):
    rows, got = given
    days = beds.bed_days(got).collect()
    assert len({d.occupancy_key for d in days}) == len(days)
    want = defaultdict(lambda: [0.0, None])
    for r in got.collect():
        day = r.start.date()
        while day <= r.end.date():
            a, b = max(r.start, datetime(day.year, day.month, day.day)), min(r.end, datetime(day.year, day.month, day.day) + timedelta(days=1))
            cell = want[r.ward_id, f"B{r.bed:06d}", int(day.strftime("%Y%m%d"))]
            cell[0] += (b - a).total_seconds() / 3600
            cell[1] = max(cell[1] or r.end, r.end)
            day += timedelta(days=1)
    assert len(days) == len(want)
    for d in days:
        hours, last = want[d.ward_id, d.bed_number_clean, d.occupancy_date_key]
        midnight = datetime.strptime(str(d.occupancy_date_key), "%Y%m%d") + timedelta(days=1)
        assert abs(hours - d.occupancy_hours) < 1e-9 and d.status == ("Cleaning" if last < midnight else "Occupied")


def test_bed_days_are_added_up_without_a_sort(spark, given):
    rows, got = given
    more = got.unionByName(got.limit(1).select(F.lit(-1).cast("long").alias("admission_id"), F.lit(9).cast("long").alias("ward_id"), "start", "end", F.lit(1_000_042).cast("long").alias("bed")))
    days = beds.bed_days(more)
    found = beds.occupancy(days)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan  # a sort would spill every bed-day
    want = defaultdict(list)
    for d in days.collect():
        want[d.ward_id, d.occupancy_date_key].append(d)
    found = found.collect()
    assert len(found) == len(want)
    for r in found:
        own = want[r.ward_id, r.occupancy_date_key]
        names = [d.bed_number_clean for d in own]
        assert (r.beds_occupied, r.beds_cleaning) == (len(own), sum(d.status == "Cleaning" for d in own))
        assert (r.first_bed, r.last_bed, r.last_key) == (min(names), max(names), max(d.occupancy_key for d in own))
        assert abs(r.occupancy_hours - sum(d.occupancy_hours for d in own)) < 1e-5


def test_hot_ward_is_split(spark):
    rows = [(i, 1, DAY0 + timedelta(minutes=i), DAY0 + timedelta(minutes=i + 90)) for i in range(4000)]
    df = spark.createDataFrame(rows, "admission_id long, ward_id long, start timestamp_ntz, end timestamp_ntz")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows, but as many parts as a large table has
    try:
        parts = ranges.RangeParts(df, ["ward_id"], ["start", "admission_id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in parts.rows.groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * len(rows)
    assert beds.assign_beds(df).agg(F.max("bed")).first()[0] == 90


def test_empty(spark):
    df = spark.createDataFrame([], "admission_id long, ward_id long, start timestamp_ntz, end timestamp_ntz")
    assert beds.bed_days(beds.assign_beds(df)).count() == 0


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_values_are_those_of_a_window(spark, inclusive):
    rng = random.Random(2)
    rows = [(None if rng.random() < 0.05 else "hot" if rng.random() < 0.5 else f"k{rng.randint(0, 30)}", i, rng.choice([None, 1, -2, 7]), rng.choice([None, None, rng.randint(0, 99)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i long, v long, x long").repartition(7)
    got = ranges.RangeParts(df, ["k"], ["i"]).running({"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("x"))}, inclusive)
    w = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    want = df.select("k", "i", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"), F.last("x", ignorenulls=True).over(w).alias("l"))
    assert sorted(map(tuple, got.select("k", "i", "s", "m", "l").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
