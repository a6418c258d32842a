"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Keys are SURVEY §2 operator ids in lower case plus a word.  Every query reads
the whole test tables through the views in ``carelake.sources.testviews``.
The matching DuckDB statements live in ``carelake.plans.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, kpi
from . import gold_build as gb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- KPIs

@register("agg_04_daily_admissions_by_ward")
def q_agg_04(spark, d):
    return kpi.daily_admissions_by_ward(gb.gold_fact_admissions(spark, d), gb.gold_dim_ward(spark, d))


@register("agg_05_daily_lab_turnaround")
def q_agg_05(spark, d):
    return kpi.daily_lab_turnaround(gb.gold_fact_lab_turnaround(spark, d))


@register("agg_06_low_stock")
def q_agg_06(spark, d):
    return kpi.pharmacy_low_stock(gb.gold_fact_pharmacy(spark, d))


@register("agg_07_daily_icu_alerts")
def q_agg_07(spark, d):
    return kpi.daily_icu_alerts(gb.gold_fact_icu_alerts(spark, d))


@register("agg_03_daily_admissions_summary")
def q_agg_03(spark, d):
    return gold.daily_admissions_summary(gb.gold_fact_admissions(spark, d))


@register("jn_04_patient_summary")
def q_jn_04(spark, d):
    counts = gold.admissions_per_patient(gb.gold_fact_admissions(spark, d))
    return gold.patient_summary(gb.gold_dim_patient(spark, d), counts, gb.ADM_AS_OF)


@register("agg_02_patient_summary_fallback")
def q_agg_02(spark, d):
    dim = gb.gold_dim_patient(spark, d)
    return gold.patient_summary(dim, gold.fallback_admission_counts(dim), gb.ADM_AS_OF)


def _utc(fn: Query) -> Query:
    """Run a query in a UTC session (PRJ-11): all source times are wall-clock."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Query]:
    # import side modules that register more queries
    from . import catalog_more  # noqa: F401

    return {name: _utc(fn) for name, fn in QUERIES.items()}
