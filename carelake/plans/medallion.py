"""End-to-end batch runs: land bronze -> silver -> gold -> validation.

Stages hand over through written Parquet tables (not through plans), so a
lost executor or a failed stage only recomputes from the last written layer,
and no lineage grows across stages.  Each table is built in isolation and
reported as ``(layer, table, rows, status, error)``; row counts are observed
during the write.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conditioning as cond
from ..operators import gold
from ..quality import results, suites
from ..sinks import publish
from ..sources import files
from ..sources import testviews as tv

CSV_OPTS = publish.CSV_WRITE_OPTIONS
NULL = publish.CSV_NULL


@dataclass(frozen=True)
class Lake:
    """Folder layout: ``<root>/{bronze,silver,gold}/<table>``."""

    root: str

    def bronze(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), "bronze", *parts])

    def silver(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{table}"


def land_test_bronze(spark: SparkSession, sf_dir: str, lake: Lake, run_id: str, run_day: datetime) -> None:
    """Land the faulty bronze views in the reference's bronze layout (SNK-02);
    the six landings are independent and run as concurrent jobs."""
    from concurrent.futures import ThreadPoolExecutor

    def labs():
        tv.bronze_lab_results(spark, sf_dir).write.mode("overwrite").parquet(publish.dated_path(lake.bronze(), "lab_results", run_day))

    def pharmacy():
        tv.bronze_pharmacy(spark, sf_dir).write.mode("overwrite").options(**CSV_OPTS).csv(lake.bronze("pharmacy"))

    def snapshot(name, view):
        def go():
            df = view(spark, sf_dir)
            # views that carry their own snapshots keep them; the others land as this run
            publish.land_snapshot(df, lake.bronze("postgres", name), None if "dt" in df.columns else run_id)

        return go

    jobs = [labs, pharmacy] + [
        snapshot(n, v)
        for n, v in (
            ("patients", tv.bronze_patients),
            ("admissions", tv.bronze_admissions),
            ("discharges", tv.bronze_discharges),
            ("wards", tv.bronze_wards),
        )
    ]
    with ThreadPoolExecutor(max_workers=4) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def bronze_to_silver(spark: SparkSession, lake: Lake, as_of: datetime) -> DataFrame:
    """Silver tables from bronze; the joined table reads the written silver."""

    def snap(name):
        return files.read_snapshots(spark, lake.bronze("postgres", name), null_value=NULL)

    builders = {
        "lab_results": lambda: cond.silver_lab_results(files.read_parquet(spark, lake.bronze("lab_results", "*", "*", "*", "*.parquet")), as_of),
        "pharmacy_inventory": lambda: cond.silver_pharmacy(files.read_csv(spark, lake.bronze("pharmacy", "*.csv"), null_value=NULL), as_of),
        "patients": lambda: cond.silver_patients(snap("patients"), as_of),
        "admissions": lambda: cond.silver_admissions(snap("admissions"), as_of),
        "discharges": lambda: cond.silver_discharges(snap("discharges"), as_of),
        "wards": lambda: cond.silver_wards(snap("wards"), as_of),
    }
    first = publish.build_tables(spark, builders, f"{lake.root.rstrip('/')}/silver")

    def read(t):
        return spark.read.parquet(lake.silver(t))

    joined = publish.build_tables(
        spark,
        {"patient_admissions": lambda: cond.patient_admissions(read("admissions"), read("discharges"), read("wards"), read("patients"), as_of)},
        f"{lake.root.rstrip('/')}/silver",
    )
    return first.unionByName(joined).withColumn("layer", F.lit("silver"))


def silver_to_gold(spark: SparkSession, lake: Lake, as_of: datetime, alerts: DataFrame | None = None) -> DataFrame:
    """Gold dimensions, facts and summaries from the written silver tables."""

    def read(t):
        return spark.read.parquet(lake.silver(t))

    gold_root = f"{lake.root.rstrip('/')}/gold"
    dims = publish.build_tables(
        spark,
        {
            "dim_patient": lambda: gold.dim_patient(read("patients"), as_of),
            "dim_ward": lambda: gold.dim_ward(read("wards"), as_of),
            "dim_date": lambda: gold.dim_date(spark, as_of),
            "dim_drug": lambda: gold.dim_drug(read("pharmacy_inventory"), as_of),
        },
        gold_root,
    )
    facts = publish.build_tables(
        spark,
        {
            "fact_admissions": lambda: gold.fact_admissions(read("admissions"), as_of),
            "fact_labs": lambda: gold.fact_labs(read("lab_results"), as_of),
            "fact_lab_turnaround": lambda: gold.fact_lab_turnaround(read("lab_results"), as_of),
            "fact_pharmacy": lambda: gold.fact_pharmacy(read("pharmacy_inventory"), as_of),
            "fact_icu_alerts": lambda: gold.fact_icu_alerts(spark, as_of, alerts),
        },
        gold_root,
    )
    # SNK-07: the stock table is a copy of the written fact, not a re-run of its plan
    stock = publish.build_tables(spark, {"fact_pharmacy_stock": lambda: spark.read.parquet(lake.gold("fact_pharmacy"))}, gold_root)

    def summary():
        dim = spark.read.parquet(lake.gold("dim_patient"))
        have_fact = bool(files.existing_paths(spark, [lake.gold("fact_admissions")]))
        counts = (
            gold.admissions_per_patient(spark.read.parquet(lake.gold("fact_admissions")))
            if have_fact
            else gold.fallback_admission_counts(dim)  # AGG-02
        )
        return gold.patient_summary(dim, counts, as_of)

    summaries = publish.build_tables(
        spark,
        {
            "patient_summary": summary,
            "daily_admissions_summary": lambda: gold.daily_admissions_summary(spark.read.parquet(lake.gold("fact_admissions"))),
        },
        gold_root,
    )
    return dims.unionByName(facts).unionByName(stock).unionByName(summaries).withColumn("layer", F.lit("gold"))


def validate_layers(spark: SparkSession, lake: Lake, as_of: datetime, run_date: str) -> DataFrame:
    """Silver and gold suites, results appended as JSON (SNK-04), roll-up (VS-19)."""

    def silver(t):
        return spark.read.parquet(lake.silver(t))

    def goldt(t):
        return spark.read.parquet(lake.gold(t))

    def checked(checks, t):
        return results.suite_result(checks, None, t, as_of, rule="plain")

    out = []
    for t in ("patients", "admissions", "pharmacy_inventory", "lab_results"):
        res = results.guarded(lambda: checked(suites.validate_silver(t, silver(t), as_of), t), t, spark, as_of)
        publish.append_validation_result(res, lake.root, "silver", run_date, t)
        out.append(res)
    for t in ("dim_patient", "fact_admissions", "fact_pharmacy", "patient_summary", "daily_admissions_summary"):
        res = results.guarded(lambda: checked(suites.validate_gold(t, goldt(t)), t), t, spark, as_of)
        publish.append_validation_result(res, lake.root, "gold", run_date, t)
        out.append(res)
    integrity = results.referential_integrity(goldt("fact_admissions"), goldt("dim_patient"), goldt("dim_ward"))
    integrity.coalesce(1).write.mode("append").json(f"{lake.root.rstrip('/')}/gold/validation/{run_date}/referential_integrity")
    return results.rollup(out)


def run(spark: SparkSession, sf_dir: str, lake: Lake, run_id: str, as_of: datetime) -> DataFrame:
    """Land, condition, build and report; returns the per-table status."""
    land_test_bronze(spark, sf_dir, lake, run_id, as_of)
    s = bronze_to_silver(spark, lake, as_of)
    g = silver_to_gold(spark, lake, as_of)
    return s.unionByName(g).select("layer", "table", "rows", "status", "error")
