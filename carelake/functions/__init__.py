"""Scalar expressions: dates, lenient parsing, text predicates, lab ranges, keys."""

from .dates import (  # noqa: F401
    age_years_365, calendar_age, date_key, date_key_str, date_lit, elapsed_hours,
    elapsed_minutes, epoch_seconds, iso_day, shift_days, shift_years, ts_lit,
)
from .keys import surrogate_key  # noqa: F401
from .parse import (  # noqa: F401
    coalesce_present, col_or_null, first_available, lenient_date, lenient_double,
    lenient_int, lenient_long, lenient_timestamp,
)
