"""Running values within groups without a task for each group.

A window over a group puts the whole group into one task.  Here rows are dealt out by ranges of (keys, order), so a
group of any size spreads over as many parts as it fills; running values are taken within each part, and what the
earlier parts of the group add up to is carried over.  Only the first and the last group of a part can go
on in another one, so the carried table has at most three rows a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

KINDS = ("sum", "max", "last")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts the lineage and fixes what a retry must not change."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RangeParts:
    """Rows in ranges of ``keys`` and ``order`` (columns of ``df``; together they should tell rows apart).

    Null keys are a group like any other; an empty table stays empty.
    """

    PART = "_part"

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], name: str = "ranges") -> None:
        self.keys, self.order = keys, order
        ranged = df.repartitionByRange(*[F.col(c) for c in [*keys, *order]])
        self.rows = written(ranged.withColumn(self.PART, F.spark_partition_id()), name)

    def _ends(self) -> DataFrame:
        """The groups that begin or end a part."""
        key = F.struct(*[F.col(c) for c in self.keys])
        first = self.rows.groupBy(self.PART).agg(F.min(key).alias("a"), F.max(key).alias("b"))
        return first.select(F.explode(F.array("a", "b")).alias("k")).select("k.*").distinct()

    def running(self, values: dict[str, tuple[str, Column]], inclusive: bool = True) -> DataFrame:
        """``rows`` with a running value of each name: ``sum`` or ``max`` of a column, or its ``last`` value that is not null.

        With ``inclusive`` the row itself counts, else only those before it in its group.  Sums and
        maxima of nothing are null.
        """
        for kind, _ in values.values():
            if kind not in KINDS:
                raise ValueError(f"unknown kind {kind}")
        reach = Window.currentRow if inclusive else -1
        here = Window.partitionBy(self.PART, *self.keys).orderBy(*self.order).rowsBetween(Window.unboundedPreceding, reach)
        local = self.rows.withColumns({n: self._over(kind, c, here) for n, (kind, c) in values.items()})
        # of each part the totals of the groups that can go on in another
        ends = self._ends()
        same = [self.rows[c].eqNullSafe(ends[c]) for c in self.keys]
        going = self.rows.join(F.broadcast(ends), same, "left_semi")  # two groups a part at most
        ordered = F.struct(*[F.col(c) for c in self.order])
        totals = going.groupBy(self.PART, *self.keys).agg(*[self._total(kind, c, ordered).alias(n) for n, (kind, c) in values.items()])
        before = Window.partitionBy(*self.keys).orderBy(self.PART).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(self.PART, *self.keys, *[self._over("last" if kind == "last" else kind, F.col(n), before).alias(f"_{n}") for n, (kind, _) in values.items()])
        carried = carried.filter(F.greatest(*[F.col(f"_{n}").isNotNull().cast("int") for n in values], F.lit(0)) == 1)
        on = [local[self.PART] == carried[self.PART], *[local[c].eqNullSafe(carried[c]) for c in self.keys]]
        joined = local.join(F.broadcast(carried), on, "left")  # three rows a part at most
        out = []
        for n, (kind, _) in values.items():
            own, more = local[n], carried[f"_{n}"]
            joint = F.coalesce(own + more, own, more) if kind == "sum" else F.greatest(own, more) if kind == "max" else F.coalesce(own, more)
            out.append(joint.alias(n))
        return joined.select(*[local[c] for c in self.rows.columns], *out)

    @staticmethod
    def _over(kind: str, c: Column, window) -> Column:
        return {"sum": F.sum(c), "max": F.max(c), "last": F.last(c, ignorenulls=True)}[kind].over(window)

    @staticmethod
    def _total(kind: str, c: Column, ordered: Column) -> Column:
        return {"sum": F.sum(c), "max": F.max(c), "last": F.max_by(c, F.when(c.isNotNull(), ordered))}[kind]
