"""Date and time expressions (FN-01..06, FN-16, FN-21).

All run JVM-side inside whole-stage codegen.  ``as_of`` values are Python
datetimes turned into NTZ literals, so boundaries are constant-folded and
identical on every executor and on every re-run.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_datetime(value: datetime | date | str) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(str(value))


def ts_lit(value: datetime | date | str) -> Column:
    """Timestamp-without-time-zone literal."""
    v = as_datetime(value)
    return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def date_lit(value: datetime | date | str) -> Column:
    return F.lit(as_datetime(value).date())


def shift_years(value: datetime | date | str, years: int) -> datetime:
    """Calendar-year offset; 29 February clips to 28 February."""
    v = as_datetime(value)
    y = v.year + years
    day = min(v.day, calendar.monthrange(y, v.month)[1])
    return v.replace(year=y, day=day)


def shift_days(value: datetime | date | str, days: int) -> datetime:
    return as_datetime(value) + timedelta(days=days)


def date_key(c: Column | str) -> Column:
    """Integer ``yyyyMMdd`` key (FN-03), computed arithmetically (no string
    formatting per row)."""
    v = F.col(c) if isinstance(c, str) else c
    return (F.year(v) * 10000 + F.month(v) * 100 + F.dayofmonth(v)).cast("int")


def date_key_str(c: Column | str) -> Column:
    """Text ``yyyyMMdd`` key."""
    return F.lpad(date_key(c).cast("string"), 8, "0")


def iso_day(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since the epoch, fractions truncated (works on NTZ)."""
    return F.unix_timestamp(F.col(c) if isinstance(c, str) else c)


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since the epoch of a wall-clock (NTZ) timestamp,
    independent of the session time zone (no cast to a zoned timestamp)."""
    v = F.col(c) if isinstance(c, str) else c
    frac = (F.date_part(F.lit("SECOND"), v) * F.lit(1_000_000)).cast("bigint") % F.lit(1_000_000)
    return F.unix_timestamp(v) * F.lit(1_000_000) + frac


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(3600.0)


def calendar_age(birth: Column | str, as_of: datetime | date | str) -> Column:
    """Age as a calendar-year difference, not birthday-aware (FN-05)."""
    b = F.col(birth) if isinstance(birth, str) else birth
    return F.when(b.isNotNull(), F.lit(as_datetime(as_of).year) - F.year(b))


def whole_days_between(start: Column | str, as_of: datetime | date | str) -> Column:
    """Whole days from ``start`` to ``as_of`` (floor of the elapsed seconds)."""
    s = F.col(start) if isinstance(start, str) else start
    return F.floor((epoch_seconds(ts_lit(as_of)) - epoch_seconds(s.cast("timestamp_ntz"))) / F.lit(86400))


def age_years_365(birth: Column | str, as_of: datetime | date | str) -> Column:
    """Age as whole elapsed days / 365.25 (FN-06)."""
    return whole_days_between(birth, as_of) / F.lit(365.25)


def calendar_frame(spark, start: str = "2019-01-01", end: str = "2026-12-31"):
    """One row per day, inclusive (SRC-08); 2,922 rows for the defaults."""
    return spark.sql(
        f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS d"
    )
