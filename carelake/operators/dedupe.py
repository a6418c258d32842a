"""One row per key (AGG-21) and row-level distinct (AGG-20).

``latest_per_key`` keeps, per key, the row with the greatest ``order_cols``
(latest snapshot first), ties broken by the remaining columns, so the winner
is deterministic and identical after any task retry.  It is written as a
``max(struct(...))`` aggregate rather than a ``row_number`` window: the
aggregate combines map-side, so a key that holds a third of all rows is
reduced inside every map task before the shuffle instead of being sorted in
one task.  Rows without a key are no duplicates of each other: all of them stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    payload = [F.col(c) for c in list(order_cols) + rest]
    if not payload:
        payload = [F.lit(0).alias("_none")]
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    best = df.filter(keyed).groupBy(*keys).agg(F.max(F.struct(*payload)).alias("_best"))
    best = best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in df.columns if c not in keys]).select(*df.columns)
    return best.unionByName(df.filter(~keyed))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row-level distinct over ``cols`` (all columns when None)."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()
