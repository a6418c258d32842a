"""Deterministic surrogate keys (PRJ-12).

The key is the first 60 bits of SHA-256 over the natural key, so it is the
same on every run, on every executor after a retry, and reproducible by any
engine that has SHA-256 (the test oracle included).  No global ordering or
single-partition window is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000")) for c in cols]
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
