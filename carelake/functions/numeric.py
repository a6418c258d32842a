"""Numeric reporting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Aggregated doubles (means, deviations, sums of fractions) are reported to this
# many decimals, so results do not depend on summation order, i.e. on how the
# data happens to be partitioned, and match other engines.
REPORT_DECIMALS = 6


def stable(c: Column, digits: int = REPORT_DECIMALS) -> Column:
    return F.round(c, digits)
