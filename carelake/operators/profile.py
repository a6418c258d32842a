"""Profiling aggregates used by the validation suites (AGG-08..24, TOP-01,
SET-02, LIM-01, JN-06).

Every operator returns a DataFrame.  Aggregates combine map-side before the
shuffle, so a value holding a third of all rows is reduced in every map task.
Totals needed next to per-group rows are attached as scalar subqueries of a
one-row aggregate, never with a global window or a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import age_years_365, epoch_micros, whole_days_between
from ..functions.lab_ranges import REFERENCE_RANGES, classify
from ..functions.numeric import stable
from .ranges import RangeParts


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row.

    All values travel in one struct-valued scalar subquery: the aggregate is
    computed once, then used as a constant by every task — no join, no cross
    product.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_v")).scalar()
    return df.withColumn("_scalar", packed).select(*df.columns, *[F.col(f"_scalar.{c}").alias(c) for c in cols])


# ---------------------------------------------------------------- duplicates and keys

def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-08: number of key groups with more than one row (NULL is one group)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count_if(F.col("n") > 1).alias("duplicate_groups"))


def surplus_duplicates(df: DataFrame, key: str) -> DataFrame:
    """AGG-09: rows beyond the first of each key value (NULLs equal each other)."""
    return df.agg(
        (F.count(F.lit(1)) - F.countDistinct(key) - F.max(F.col(key).isNull().cast("int"))).cast("bigint").alias("surplus_rows")
    ).select(F.coalesce("surplus_rows", F.lit(0)).cast("bigint").alias("surplus_rows"))


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """AGG-10: rows against distinct keys (NULL counted as one key, as ``distinct()``)."""
    agg = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.countDistinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))).cast("bigint").alias("unique_keys"),
    )
    return agg.withColumn("keys_unique", F.col("total_rows") == F.col("unique_keys"))


# ---------------------------------------------------------------- distributions

def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """AGG-11: count per non-NULL value."""
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def rare_values(df: DataFrame, col: str, share: float = 0.001) -> DataFrame:
    """AGG-12: values whose count is below ``max(1, rows * share)``."""
    counts = value_distribution(df, col)
    total = df.agg(F.count(F.lit(1)).alias("_rows"))
    limit = F.greatest(F.lit(1.0), F.col("_rows") * F.lit(share))
    return attach_scalar(counts, total).filter(F.col("count") < limit).select("value", "count")


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """TOP-01: k most frequent non-NULL values, ties broken by value.

    ``orderBy().limit()`` plans as a per-partition top-k merged on one task,
    so only k rows per partition move.
    """
    return value_distribution(df, col).orderBy(F.desc("count"), F.asc("value")).limit(k)


def distinct_sample(df: DataFrame, col: str, n: int) -> DataFrame:
    """AGG-23: the first ``n`` distinct non-NULL values in sort order."""
    return df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct().orderBy("value").limit(n)


def unknown_values(df: DataFrame, col: str, known: Sequence[str]) -> DataFrame:
    """SET-02: distinct observed values that are not in ``known`` (case-sensitive)."""
    return (
        df.select(F.col(col).alias("value"))
        .filter(F.col("value").isNotNull() & ~F.col("value").isin(list(known)))
        .distinct()
    )


def extract_limit(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """LIM-01: capped extract; ordered so that the cap is deterministic."""
    return df.orderBy(*order_by).limit(n)


# ---------------------------------------------------------------- statistics

def date_range(df: DataFrame, col: Column | str) -> DataFrame:
    """AGG-13: earliest and latest value as ISO text."""
    c = _c(col)
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    return df.agg(F.date_format(F.min(c), fmt).alias("earliest"), F.date_format(F.max(c), fmt).alias("latest"))


def quantity_stats(df: DataFrame, col: Column | str) -> DataFrame:
    """AGG-14: total and mean of a numeric column."""
    c = _c(col)
    return df.agg(F.sum(c).alias("total_quantity"), F.avg(c).alias("avg_quantity"))


def exact_median(values: DataFrame, col: str) -> DataFrame:
    """Exact median (mean of the two middle values for an even count).

    Distributed order statistic: distinct values with their counts are range
    partitioned and checkpointed (so partition ids are stable), running
    counts are formed per partition plus a prefix over the per-partition sums
    (one row per partition), and the one or two middle values are picked by
    rank.  No task ever holds more than one range partition of distinct
    values.
    """
    counts = values.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, "v").withColumn("pid", F.spark_partition_id()).checkpoint()
    psum = ranged.groupBy("pid").agg(F.sum("c").alias("ps"))
    psum = psum.withColumn("offset", F.sum("ps").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)))
    psum = psum.select("pid", F.coalesce("offset", F.lit(0)).alias("offset"))
    total = ranged.agg(F.sum("c").alias("n"))
    cum = ranged.join(F.broadcast(psum), "pid").withColumn(
        "hi", F.col("offset") + F.sum("c").over(Window.partitionBy("pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("lo", F.col("hi") - F.col("c") + 1)
    cum = attach_scalar(cum, total)
    k1 = F.floor((F.col("n") + 1) / 2)
    k2 = F.floor(F.col("n") / 2) + 1
    picks = cum.filter(((F.col("lo") <= k1) & (k1 <= F.col("hi"))) | ((F.col("lo") <= k2) & (k2 <= F.col("hi"))))
    val = F.when(F.col("n") % 2 == 1, F.max(F.when((F.col("lo") <= k1) & (k1 <= F.col("hi")), F.col("v")))).otherwise(
        (F.max(F.when((F.col("lo") <= k1) & (k1 <= F.col("hi")), F.col("v")))
         + F.max(F.when((F.col("lo") <= k2) & (k2 <= F.col("hi")), F.col("v")))) / 2.0
    )
    out = picks.groupBy("n").agg(val.alias("median"))
    empty = values.sparkSession.createDataFrame([(None,)], "median double")
    return out.select(F.col("median").cast("double")).unionByName(empty).agg(F.max("median").alias("median"))


def result_statistics(df: DataFrame, col: str) -> DataFrame:
    """AGG-15: mean, median, sample std, min and max of the non-NULL values."""
    base = df.agg(
        stable(F.avg(col)).alias("mean"),
        stable(F.stddev_samp(col)).alias("std"),
        F.min(col).cast("double").alias("min"),
        F.max(col).cast("double").alias("max"),
    )
    med = exact_median(df, col).select(stable(F.col("median")).alias("median"))
    return attach_scalar(base, med).select("mean", "median", "std", "min", "max")


def tests_per_day(df: DataFrame, ts: Column | str) -> DataFrame:
    """AGG-16: valid tests divided by the number of distinct test days."""
    t = _c(ts)
    return df.agg(
        F.try_divide(F.count(t).cast("double"), F.countDistinct(F.to_date(t)).cast("double")).alias("avg_tests_per_day")
    )


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG-17: distinct non-NULL values per column, one aggregate pass."""
    return df.agg(*[F.countDistinct(c).alias(f"unique_{c}") for c in cols])


def average_age(df: DataFrame, birth: Column | str, as_of: datetime) -> DataFrame:
    """AGG-22: mean of whole days since birth / 365.25, two decimals."""
    days = whole_days_between(_c(birth), as_of)
    return df.agg(F.round(F.avg(days) / F.lit(365.25), 2).alias("average_age"))


def age_band_counts(df: DataFrame, birth: Column | str, as_of: datetime, lo: float = 0, hi: float = 120) -> DataFrame:
    age = age_years_365(_c(birth), as_of)
    return df.agg(F.count_if(age < lo).alias("too_young"), F.count_if(age > hi).alias("too_old"))


# ---------------------------------------------------------------- lab classes

def _class_statistics(df: DataFrame, test_type: str, value: str) -> DataFrame:
    """The statistics of :func:`class_statistics` as computed, for decisions."""
    bounds_lo = F.create_map(*[x for n, lo, _ in REFERENCE_RANGES for x in (F.lit(n), F.lit(lo))])
    bounds_hi = F.create_map(*[x for n, _, hi in REFERENCE_RANGES for x in (F.lit(n), F.lit(hi))])
    rows = df.filter(F.col(value).isNotNull()).select(classify(test_type).alias("range_name"), F.col(value).alias("x"))
    rows = rows.filter(F.col("range_name").isNotNull())
    lo = F.element_at(bounds_lo, F.col("range_name"))
    hi = F.element_at(bounds_hi, F.col("range_name"))
    stats = rows.groupBy("range_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.count_if(F.col("x") < lo).alias("below_range"),
        F.count_if(F.col("x") > hi).alias("above_range"),
    )
    stats = stats.withColumn("total_abnormal", F.col("below_range") + F.col("above_range"))
    stats = stats.withColumn("abnormal_pct", F.col("total_abnormal").cast("double") / F.col("count"))
    more_than_half = F.col("total_abnormal") * 2 > F.col("count")
    return stats.withColumn(
        "severity", F.when(F.col("total_abnormal") == 0, F.lit(None)).when(more_than_half, F.lit("issue")).otherwise(F.lit("warning"))
    )


def class_statistics(df: DataFrame, test_type: str, value: str) -> DataFrame:
    """AGG-18: per reference-range class of the numeric results.

    Rows are classified once (first substring match wins); one grouped pass
    gives count, mean, sample std and the values below / above the range
    (bounds are exclusive: a value equal to a bound is normal).  Numbers are
    rounded for the report alone: the severity is decided on the counts.
    """
    return _class_statistics(df, test_type, value).withColumns({c: stable(F.col(c)) for c in ("mean", "std", "abnormal_pct")})


def class_outliers(df: DataFrame, test_type: str, value: str, sd: float = 4.0, min_count: int = 10) -> DataFrame:
    """AGG-19: |x - mean| > sd * std per class, when count > min_count and std > 0.

    Class statistics (at most 12 rows) are broadcast back onto the rows.
    """
    stats = _class_statistics(df, test_type, value).select("range_name", "count", "mean", "std")
    rows = df.filter(F.col(value).isNotNull()).select(classify(test_type).alias("range_name"), F.col(value).alias("x"))
    joined = rows.join(F.broadcast(stats), "range_name")
    eligible = (F.col("count") > min_count) & (F.col("std") > 0)
    flagged = eligible & (F.abs(F.col("x") - F.col("mean")) > F.lit(sd) * F.col("std"))
    return joined.groupBy("range_name").agg(F.count_if(flagged).alias("outliers"))


# ---------------------------------------------------------------- time-keyed checks

def same_time_groups(df: DataFrame, patient: str, ts: Column | str) -> DataFrame:
    """AGG-24: (patient, exact test time) groups with more than one row."""
    g = df.filter(_c(ts).isNotNull() & F.col(patient).isNotNull()).groupBy(patient, _c(ts).alias("_t")).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count_if(F.col("n") > 1).alias("multi_test_groups"))


def test_intervals(df: DataFrame, patient: str, ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """WIN-01: seconds and whole days since the patient's previous test.

    Rows are dealt out by ranges of (patient, time), and the last time of a patient is carried from part to part
    (:mod:`.ranges`): one scan, no self-join, and a patient or a patient's hour with a third of all rows spreads over
    as many tasks as it fills.  Equal times give an interval of 0.
    """
    base = df.filter(F.col(ts).isNotNull() & F.col(patient).isNotNull())
    parts = RangeParts(base, [patient], [ts, *tiebreak], "test-times")
    rows = parts.running({"previous_test_time": ("last", F.col(ts))}, inclusive=False)
    micros = epoch_micros(ts) - epoch_micros("previous_test_time")
    return rows.select(
        *df.columns,
        "previous_test_time",
        (micros / F.lit(1_000_000.0)).alias("seconds_since_previous"),
        F.floor(micros / F.lit(86_400_000_000)).alias("days_since_previous"),
    )


def frequent_tests(df: DataFrame, patient: str, ts: str) -> DataFrame:
    """Count of tests taken less than one day after the patient's previous test.

    Pure aggregation: rows are grouped by (patient, day bucket) keeping
    count, earliest and latest time.  Within a bucket every row but the
    first follows its predecessor by less than a day; the first row's
    predecessor can only be within a day if it is the latest row of the
    previous day bucket, so one equi-join of bucket b with bucket b-1
    finishes the count.  A patient holding a third of all rows is reduced
    map-side to one row per day before any shuffle.
    """
    us = epoch_micros(ts)
    base = df.filter(F.col(ts).isNotNull() & F.col(patient).isNotNull()).select(
        F.col(patient).alias("_p"), us.alias("_us"), F.floor(us / F.lit(86_400_000_000)).alias("_b")
    )
    g = base.groupBy("_p", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
    prev = g.select("_p", (F.col("_b") + 1).alias("_b"), F.col("_hi").alias("_prev_hi"))
    j = g.join(prev, ["_p", "_b"], "left")
    crosses = F.when(F.col("_prev_hi").isNotNull() & (F.col("_lo") - F.col("_prev_hi") < F.lit(86_400_000_000)), 1).otherwise(0)
    return j.agg(F.coalesce(F.sum(F.col("_n") - 1 + crosses), F.lit(0)).cast("bigint").alias("frequent_tests"))


# ---------------------------------------------------------------- integrity

def missing_references(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """JN-06: fact rows whose non-NULL ``key`` is absent from the dimension.

    A left-anti join on the key (the dimension side is reduced to distinct
    keys first); NULL fact keys are not counted as missing.
    """
    keys = dim.select(key).filter(F.col(key).isNotNull()).distinct()
    return fact.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")
