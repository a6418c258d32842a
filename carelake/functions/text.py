"""String predicates and standardisation (FN-09..13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's validation rules.
ID_PATTERN = r"^[A-Za-z0-9\-_]+$"
DIGITS_ONLY_PATTERN = r"^\d+$"
UNUSUAL_NAME_CHARS = r"[0-9@#$%^&*]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# What the reference's text functions take as white space.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column | str) -> Column:
    """White space of any kind taken off both ends."""
    return F.trim(_c(c).cast("string"), F.lit(WHITE_SPACE))


def standardise(c: Column | str) -> Column:
    """lower + strip (FN-09)."""
    return strip(F.lower(_c(c)))


def is_blank(c: Column | str) -> Column:
    """NULL, empty or whitespace only (FLT-05); never NULL itself."""
    v = _c(c)
    return v.isNull() | (strip(v) == F.lit(""))


def has_valid_id_format(c: Column | str) -> Column:
    """Identifier pattern; NULL input gives NULL (so it is never flagged)."""
    return _c(c).cast("string").rlike(ID_PATTERN)


def is_digits_only(c: Column | str) -> Column:
    return F.coalesce(_c(c).cast("string").rlike(DIGITS_ONLY_PATTERN), F.lit(False))


def has_unusual_chars(c: Column | str) -> Column:
    return F.coalesce(_c(c).cast("string").rlike(UNUSUAL_NAME_CHARS), F.lit(False))


def text_length(c: Column | str) -> Column:
    return F.length(_c(c).cast("string"))
