"""Lenient parsing and column resolution (FN-14, FN-15, PRJ-02..07).

Spark 4 runs with ANSI mode on, where ``cast``/``to_timestamp`` throw on bad
input; every conditioning step therefore uses the ``try_`` forms so that a
malformed value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: Column | str) -> Column:
    """Numeric parse; unparsable text and the text 'NaN' become NULL."""
    v = F.trim(_c(c).cast("string")).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def lenient_long(c: Column | str) -> Column:
    """Integer parse; '12.0' is 12 and fractions truncate.  Never through double, which merges ids beyond 2^53."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(s.try_cast("bigint"), s.try_cast("decimal(38,10)").try_cast("bigint"))


def lenient_int(c: Column | str) -> Column:
    return lenient_long(c).try_cast("int")


def canonical_id(c: Column | str) -> Column:
    """An identifier as text: digits for numeric forms ('012', '12.0' are '12'), anything else as it stands, without
    the white space around it; blank is NULL.  Nothing that identifies a row is lost to a cast."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(lenient_long(c).cast("string"), F.when(s != "", s))


# Forms other than ISO that sources send, tried in this order (with the length that tells them apart).
DATE_FORMS = [("yyyy/MM/dd", 10), ("yyyy/MM/dd HH:mm:ss", 19), ("dd MMM yyyy", 11), ("yyyyMMdd", 8)]


def lenient_timestamp(c: Column | str) -> Column:
    """Timestamp parse of ISO text (date, date-time, 'T' separator, fractions) and of ``DATE_FORMS``.

    Eight digits are a date, not a year; text of no known form is NULL."""
    s = F.trim(_c(c).cast("string"))
    digits = s.rlike("^[0-9]{8}$")
    iso = F.when(~digits, F.try_to_timestamp(s))
    others = [F.when(F.length(s) == n, F.try_to_timestamp(s, F.lit(form))) for form, n in DATE_FORMS]
    return F.coalesce(iso, *others).cast("timestamp_ntz")


def date_form(c: Column | str) -> Column:
    """Which form a text has: ``iso``, one of ``DATE_FORMS``, ``blank`` or ``unknown``; one pass over a column so votes on its form."""
    s = F.trim(_c(c).cast("string"))
    found = F.when(s.isNull() | (s == ""), "blank").when(~s.rlike("^[0-9]{8}$") & F.try_to_timestamp(s).isNotNull(), "iso")
    for form, n in DATE_FORMS:
        found = found.when((F.length(s) == n) & F.try_to_timestamp(s, F.lit(form)).isNotNull(), form)
    return found.otherwise("unknown")


def lenient_date(c: Column | str) -> Column:
    return lenient_timestamp(c).cast("date")


def first_available(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First candidate name present in ``df`` (G16 resolver)."""
    cols = set(df.columns)
    for name in candidates:
        if name in cols:
            return name
    return None


def col_or_null(df: DataFrame, name: str, dtype: DataType | str) -> Column:
    """The column if present, else a typed NULL (optional-column step)."""
    if name in df.columns:
        return F.col(name).cast(dtype)
    return F.lit(None).cast(dtype)


def coalesce_present(df: DataFrame, candidates: Iterable[str], convert=None) -> Column | None:
    """Coalesce over the candidates present in ``df``, each converted first."""
    conv = convert or (lambda x: F.col(x))
    present = [conv(c) for c in candidates if c in df.columns]
    if not present:
        return None
    return present[0] if len(present) == 1 else F.coalesce(*present)
