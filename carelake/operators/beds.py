"""Bed assignment: stays of a ward on numbered beds, as few as ever are needed at once, and the bed-day fact (DOC-09).

The beds of a ward are a queue.  A stay opens a new bed if more stays overlap at its start than ever before, and
otherwise takes the bed that has been free longest.  The r-th stay that takes a used bed therefore takes the bed which the r-th
discharge of the ward freed: who follows whom on a bed comes out of running counts alone, which are spread over ranges of
time (:mod:`.ranges`), so the stays of one large ward never meet in one task.  Bed numbers are then found by
pointer doubling along the beds, in as many rounds as the logarithm of the most stays on one bed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, elapsed_hours, ts_lit
from .ranges import RangeParts, written

BED_DIGITS = 6  # of a bed's name


def assign_beds(stays: DataFrame, name: str = "beds") -> DataFrame:
    """``admission_id, ward_id, start, end`` with ``bed`` (from 1 in each ward).

    No two stays of a ward are on one bed at a time, and a ward has as many beds as stays ever overlap.  A bed
    left at an instant can be taken at it; of equal instants the smaller ``admission_id`` comes first.  A stay without length
    takes a bed too.  Rows need a start, an end not before it and their own ``admission_id``; a null ward is a ward of its own.
    """
    own = stays.select("admission_id", "ward_id", "start", "end")
    empty = F.col("start") == F.col("end")
    # at one instant beds are left, then taken, then left by stays without length
    event = F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("kind")),
        F.struct(F.col("end").alias("at"), F.when(empty, 2).otherwise(0).alias("kind")),
    ))
    events = own.select("admission_id", "ward_id", event.alias("e")).select("admission_id", "ward_id", "e.at", "e.kind")
    start = F.col("kind") == 1
    parts = RangeParts(events, ["ward_id"], ["at", "kind", "admission_id"], f"{name}-events")
    counted = parts.running({
        "open": ("sum", F.when(start, 1).otherwise(-1)), "starts": ("sum", F.when(start, 1).otherwise(0)), "ends": ("sum", F.when(start, 0).otherwise(1)),
    })
    parts.rows = written(counted, f"{name}-counts")
    peaks = parts.running({"peak": ("max", F.col("open"))}, inclusive=False).withColumn("peak", F.coalesce("peak", F.lit(0)))
    peaks = written(peaks, f"{name}-peaks")
    # a start that raises the peak opens the bed of that number; any other is reuse number starts - peak
    opens = F.col("open") > F.col("peak")
    starts = peaks.filter(start).select("admission_id", "ward_id", F.when(opens, F.col("open")).alias("bed"), F.when(~opens, F.col("starts") - F.col("peak")).alias("reuse"))
    left = peaks.filter(~start).select(F.col("admission_id").alias("up"), F.col("ward_id").alias("_w"), F.col("ends").alias("reuse_of"))
    link = starts.join(left, starts["ward_id"].eqNullSafe(left["_w"]) & (starts["reuse"] == left["reuse_of"]), "left").select("admission_id", "ward_id", "bed", "up")
    link = written(link, f"{name}-links")
    while link.filter(F.col("bed").isNull()).limit(1).count():
        ahead = link.select(F.col("admission_id").alias("_id"), F.col("bed").alias("_bed"), F.col("up").alias("_up"))
        # each stay is followed by one other at most, so no key of this join repeats
        known, waiting = link.filter(F.col("bed").isNotNull()), link.filter(F.col("bed").isNull())
        moved = waiting.join(ahead, waiting["up"] == ahead["_id"]).select("admission_id", "ward_id", F.col("_bed").alias("bed"), F.when(F.col("_bed").isNull(), F.col("_up")).alias("up"))
        link = written(known.unionByName(moved), f"{name}-links")
    return own.join(link.select("admission_id", F.col("bed").cast("long").alias("bed")), "admission_id")


def stays_of(adm_facts: DataFrame, open_until: datetime) -> DataFrame:
    """Stays with a start and an end; those without a discharge last until ``open_until``.  Stays that end before they
    start, or have no start, are left out (``extensions.stay_status`` names them)."""
    end = F.coalesce(F.col("discharge_timestamp"), ts_lit(open_until))
    stays = adm_facts.select("admission_id", "ward_id", F.col("admission_timestamp").alias("start"), end.alias("end"))
    return stays.filter(F.col("start").isNotNull() & (F.col("end") >= F.col("start")))


def bed_days(beds: DataFrame) -> DataFrame:
    """DOC-09, one row per bed and day: ``occupancy_key, ward_id, occupancy_date_key, bed_number_clean, status, occupancy_hours, is_occupied``.

    ``status`` is that at the end of the day: ``Occupied``, or ``Cleaning`` after the last stay of the day has left.  The key packs
    ward, bed and day (20 bits for the bed, 17 for the day), so no two rows share one.  Days inside a stay are its own; only its
    first and last day can be shared with other stays of the bed, so only these are grouped.  ``day`` and ``bed_code`` follow, the
    date and the digits of the bed's name as a number, for sums over many rows: they are compared without making a text of each.
    """
    # a stay becomes thousands of rows: stays are worked out once and dealt out evenly before that, however few files hold them;
    # in their order, so that what adds up their days by ward stays within the days of one ward for long
    parts = int(beds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(beds.select("ward_id", "bed", "start", "end").repartition(parts, "ward_id", "bed", "start").sortWithinPartitions("ward_id", "start"), "bed-stays")
    d0, d1 = F.to_date("start"), F.to_date("end")
    own = dealt.select("ward_id", "bed", "start", "end", d0.alias("d0"), d1.alias("d1"))
    nights = F.datediff("d1", "d0")
    inside = own.filter(nights > 1).select("ward_id", "bed", "d0", F.explode(F.sequence(F.lit(1), nights - 1)).alias("_n"))
    inside = inside.select("ward_id", "bed", F.date_add("d0", F.col("_n")).alias("day"), F.lit(24.0).alias("hours"), F.lit(False).alias("left"))
    edge = own.select("ward_id", "bed", "start", "end", F.explode(F.array_distinct(F.array("d0", "d1"))).alias("day"))
    midnight = F.date_add("day", 1).cast("timestamp_ntz")
    hours = elapsed_hours(F.greatest("start", F.col("day").cast("timestamp_ntz")), F.least("end", midnight))
    edge = edge.select("ward_id", "bed", "day", "start", "end", hours.alias("hours"))
    edge = edge.groupBy("ward_id", "bed", "day").agg(F.sum("hours").alias("hours"), F.max("end").alias("_last"))
    edge = edge.select("ward_id", "bed", "day", "hours", (F.col("_last") < midnight).alias("left"))
    every = inside.unionByName(edge)
    day = F.datediff("day", F.lit("1900-01-01").cast("date")).cast("long")
    key = (F.coalesce(F.col("ward_id"), F.lit(-1)) * (1 << 20) + F.col("bed")) * (1 << 17) + day
    digits = F.lpad(F.col("bed").cast("string"), BED_DIGITS, "0")
    # a bed of more digits has its first ones in its name
    code = F.when(F.col("bed") < 10**BED_DIGITS, F.col("bed")).otherwise(digits.cast("long"))
    return every.select(
        key.alias("occupancy_key"),
        "ward_id",
        date_key("day").alias("occupancy_date_key"),
        F.concat(F.lit("B"), digits).alias("bed_number_clean"),
        F.when(F.col("left"), "Cleaning").otherwise("Occupied").alias("status"),
        F.col("hours").alias("occupancy_hours"),
        F.lit(1).alias("is_occupied"),
        "day",
        code.alias("bed_code"),
    )


def bed_name(code: Column) -> Column:
    """``bed_number_clean`` of a ``bed_code``."""
    return F.concat(F.lit("B"), F.lpad(code.cast("string"), BED_DIGITS, "0"))


def occupancy(days: DataFrame) -> DataFrame:
    """Bed-days added up by ward and day.

    All that is kept while rows are added up is of fixed width (the smallest and largest bed as numbers, named afterwards; the date
    instead of its key), so that Spark adds up in a hash table of one entry per ward and day; a text among the
    values would have every bed-day sorted first, and spilled.
    """
    found = days.groupBy("ward_id", "day").agg(
        F.sum("is_occupied").alias("beds_occupied"),
        F.count_if(F.col("status") == "Cleaning").alias("beds_cleaning"),
        F.min("bed_code").alias("_first"),
        F.max("bed_code").alias("_last"),
        F.max("occupancy_key").alias("last_key"),
        F.round(F.sum("occupancy_hours"), 6).alias("occupancy_hours"),
    )
    return found.select(
        "ward_id", date_key("day").alias("occupancy_date_key"), "beds_occupied", "beds_cleaning",
        bed_name(F.col("_first")).alias("first_bed"), bed_name(F.col("_last")).alias("last_bed"), "last_key", "occupancy_hours",
    )
