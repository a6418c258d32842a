"""Source and sink round trips: each query lands test-view data in the shared
scratch folder with a library sink and reads it back with a library source."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import conditioning as cond
from ..operators import gold, kpi
from ..quality import results, suites
from ..session import scratch_path
from ..sinks import publish
from ..sources import files
from ..sources import testviews as tv
from . import gold_build as gb
from ..functions.parse import canonical_id, lenient_long
from ..operators import quarantine
from ..operators.registry import KeyRegistry
from ..sinks.bucketed import BucketedTable
from .catalog import register

CSV_OPTS = publish.CSV_WRITE_OPTIONS


@register("src_04_snapshot_scan")
def q_src_04(spark, d):
    root = scratch_path(spark, "bronze-patients")
    bronze = tv.bronze_patients(spark, d)
    for run in ("2001-07-01", "2001-08-01"):
        publish.land_snapshot(bronze.filter(F.col("dt") == run).drop("dt"), root, run)
    landed = files.read_snapshots(spark, root, null_value=publish.CSV_NULL)
    return cond.silver_patients(landed, gb.ADM_AS_OF)


@register("src_05_multi_csv")
def q_src_05(spark, d):
    folder = scratch_path(spark, "lab-csv")
    tv.bronze_lab_results(spark, d).write.options(**CSV_OPTS).csv(folder)
    paths = files.list_files(spark, folder, ".csv") + [f"{folder}/absent.csv"]
    labs = files.read_multi_csv(spark, paths, fallback_paths=[f"{folder}-fallback/x.csv"], null_value=publish.CSV_NULL)
    out = cond.silver_lab_results(labs, gb.LAB_AS_OF)
    return out.withColumn("has_source", F.col("source_file").startswith("part-")).drop("source_file")


@register("src_07_nested_json")
def q_src_07(spark, d):
    folder = scratch_path(spark, "pharmacy-json")
    raw = tv.bronze_pharmacy(spark, d)
    # fixture: many documents of the form {"drugs": [...]} (one per bucket)
    docs = raw.groupBy(F.pmod(F.xxhash64("drug_id", "drug_name", "quantity"), F.lit(64)).alias("_b")).agg(
        F.collect_list(F.struct(*raw.columns)).alias("drugs")
    )
    docs.select("drugs").write.option("ignoreNullFields", False).json(folder)
    drugs = files.read_nested_json(spark, folder, "drugs", multi_line=False)
    return cond.silver_pharmacy(drugs.select(*raw.columns), gb.LAB_AS_OF)


@register("snk_04_results_json")
def q_snk_04(spark, d):
    root = scratch_path(spark, "validation")
    bronze = tv.bronze_pharmacy(spark, d)
    res = results.suite_result(suites.validate_pharmacy(bronze, gb.LAB_AS_OF), bronze, "pharmacy", gb.LAB_AS_OF, "pharmacy", 0.01, 0)
    path = publish.append_validation_result(res, root, "silver", "2024-02-01", "pharmacy")
    back = spark.read.schema(results.RESULT_SCHEMA).json(path)
    return back.select("table_name", "row_count", "issue_count", "warning_count", "passed", "quality_score")


@register("snk_07_publish_twice")
def q_snk_07(spark, d):
    root = scratch_path(spark, "gold")
    publish.publish_twice(gb.gold_fact_pharmacy(spark, d), f"{root}/fact_pharmacy", f"{root}/fact_pharmacy_stock")
    return spark.read.parquet(f"{root}/fact_pharmacy_stock")


@register("snk_08_table_builds")
def q_snk_08(spark, d):
    root = scratch_path(spark, "gold-builds")
    builders = {
        "dim_ward": lambda: gb.gold_dim_ward(spark, d),
        "dim_patient": lambda: gb.gold_dim_patient(spark, d),
        "fact_admissions": lambda: gb.gold_fact_admissions(spark, d),
        "dim_drug": lambda: gold.dim_drug(tv.pharmacy_inventory(spark, d).drop("drug_name"), gb.LAB_AS_OF),
        "fact_labs": lambda: gold.fact_labs(files.read_layer_table(spark, root, "silver", "lab_results"), gb.LAB_AS_OF),
    }
    return publish.build_tables(spark, builders, root).select("table", "rows", "status")


@register("snk_05_external_tables")
def q_snk_05(spark, d):
    root = scratch_path(spark, "gold-ext")
    tag = uuid.uuid4().hex[:8]
    publish.write_table(gb.gold_fact_admissions(spark, d), f"{root}/fact_admissions")
    publish.write_table(gb.gold_dim_ward(spark, d), f"{root}/dim_ward")
    problems = publish.register_external_table(spark, f"fact_admissions_{tag}", f"{root}/fact_admissions", "fact_admissions")
    problems += publish.register_external_table(spark, f"dim_ward_{tag}", f"{root}/dim_ward", "dim_ward")
    if problems:
        raise ValueError(f"contract mismatch: {problems}")
    view = f"kpi_daily_admissions_by_ward_{tag}"
    publish.publish_view(
        spark.sql(
            f"""SELECT date_format(a.admission_time, 'yyyyMMdd') AS date_key_str,
                       CAST(date_format(a.admission_time, 'yyyyMMdd') AS INT) AS date_key,
                       a.ward_id, w.ward_name, COUNT(*) AS admissions
                FROM fact_admissions_{tag} a LEFT JOIN dim_ward_{tag} w ON a.ward_id = w.ward_id
                GROUP BY 1, 2, 3, 4"""
        ),
        view,
    )
    return spark.table(view)


@register("snk_06_named_objects")
def q_snk_06(spark, d):
    """All eight gold tables as external tables that hold their contract, the four KPI
    views over them, and the rows of each."""
    root, tag = scratch_path(spark, "gold-named"), uuid.uuid4().hex[:8]
    builders = {
        "dim_patient": lambda: gb.gold_dim_patient(spark, d),
        "dim_ward": lambda: gb.gold_dim_ward(spark, d),
        "dim_date": lambda: gold.dim_date(spark, gb.LAB_AS_OF),
        "dim_drug": lambda: gold.dim_drug(tv.pharmacy_inventory(spark, d), gb.LAB_AS_OF),
        "fact_admissions": lambda: gb.gold_fact_admissions(spark, d),
        "fact_lab_turnaround": lambda: gb.gold_fact_lab_turnaround(spark, d),
        "fact_pharmacy": lambda: gb.gold_fact_pharmacy(spark, d),
        "fact_icu_alerts": lambda: gb.gold_fact_icu_alerts(spark, d),
    }
    report = publish.build_tables(spark, builders, root)
    failed = [r.error for r in report.filter("status <> 'ok'").collect()]
    problems = [p for t in builders for p in publish.register_external_table(spark, f"{t}_{tag}", f"{root}/{t}", t)] if not failed else failed
    if problems:
        raise ValueError(f"gold tables: {problems}")
    named = {t: spark.table(f"{t}_{tag}") for t in builders}
    views = {
        "kpi_daily_admissions_by_ward": kpi.daily_admissions_by_ward(named["fact_admissions"], named["dim_ward"]),
        "kpi_daily_lab_turnaround": kpi.daily_lab_turnaround(named["fact_lab_turnaround"]),
        "kpi_low_stock": kpi.pharmacy_low_stock(named["fact_pharmacy"]),
        "kpi_daily_icu_alerts": kpi.daily_icu_alerts(named["fact_icu_alerts"]),
    }
    for v, df in views.items():
        publish.publish_view(df, f"{v}_{tag}")
    objects = [("table", t) for t in builders] + [("view", v) for v in views]
    out = None
    for kind, name in objects:
        one = spark.table(f"{name}_{tag}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), F.lit(name).alias("object"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("run_01_medallion_build")
def q_run_01(spark, d):
    from .medallion import Lake, run

    lake = Lake(scratch_path(spark, "lake"))
    status = run(spark, d, lake, "20240201T000000Z", gb.LAB_AS_OF)
    return status.select("layer", "table", "rows", "status")


@register("str_01_incremental_labs")
def q_str_01(spark, d):
    """Two landings ingested by two incremental runs of one streaming job."""
    from ..streaming.incremental import ingest_labs_to_silver

    root = scratch_path(spark, "stream-labs")
    raw = tv.bronze_lab_results(spark, d)
    # two landing folders, one per run: lab rows of the first 15 days, then the rest
    day = F.dayofmonth(F.to_date(F.substring("collected_time", 1, 10)))
    raw.filter(day <= 15).write.parquet(f"{root}/landing/2024/01/15")
    ck, silver = f"{root}/_checkpoint", f"{root}/silver"
    ingest_labs_to_silver(spark, f"{root}/landing/*/*/*", raw.schema, silver, ck, gb.LAB_AS_OF).awaitTermination()
    raw.filter(~(day <= 15)).write.parquet(f"{root}/landing/2024/01/31")
    ingest_labs_to_silver(spark, f"{root}/landing/*/*/*", raw.schema, silver, ck, gb.LAB_AS_OF).awaitTermination()
    return spark.read.parquet(silver)


@register("prj_05_quarantine")
def q_prj_05(spark, d):
    """Every raw row of three tables on its side, with the reasons of the rejected ones."""
    sides = None
    for name, view, key, rules in (
        ("labs", tv.bronze_lab_results, "lab_result_id", quarantine.lab_rules()),
        ("pharmacy", tv.bronze_pharmacy, "drug_id", quarantine.pharmacy_rules()),
        ("admissions", tv.bronze_admissions, "admission_id", quarantine.admission_rules()),
    ):
        routed = quarantine.route(view(spark, d), rules, scratch_path(spark, f"quarantine-{name}"))
        kept = routed.accepted.select(F.lit(name).alias("source"), F.lit("accepted").alias("side"), canonical_id(key).alias("row_id"), F.lit("").alias("reasons"))
        out = routed.rejected.select(F.lit(name).alias("source"), F.lit("rejected").alias("side"), canonical_id(key).alias("row_id"), F.array_join("reject_reasons", ",").alias("reasons"))
        both = kept.unionByName(out)
        sides = both if sides is None else sides.unionByName(both)
    return sides


#: (name, snapshots): what arrives in turn at the patients' table, a late snapshot and deletions included
def _patient_changes(spark, d):
    raw = tv.bronze_patients(spark, d).select(lenient_long("patient_id").alias("patient_id"), "first_name", "last_name", "dt")
    late = raw.filter((F.col("dt") == "2001-07-01") & (F.col("patient_id") % 25 == 0)).withColumn("last_name", F.lit("late")).withColumn("dt", F.lit("2001-07-15"))
    gone = raw.filter((F.col("dt") == "2001-07-01") & (F.col("patient_id") % 40 == 0)).withColumn("dt", F.lit("2001-07-20"))
    return [
        (raw.filter(F.col("dt") == "2001-08-01"), None),
        (raw.filter(F.col("dt") == "2001-07-01"), None),
        (gone, F.lit(True)),
        (late, None),
    ]


@register("src_04_incremental_silver")
def q_src_04_incremental(spark, d):
    """Snapshots merged one after another, out of order, into bucketed silver; the table as it then stands."""
    table = BucketedTable(spark, scratch_path(spark, "silver-patients"), ["patient_id"], ["dt"], buckets=16)
    for changes, deleted in _patient_changes(spark, d):
        table.merge(changes, deleted)
    return table.read()


@register("prj_12_key_registry")
def q_prj_12(spark, d):
    """Numbers of (ward, patient): those of the critical admissions first, then of all; every key keeps its number."""
    stays = tv.admissions(spark, d).select("ward_id", "patient_id", "triage_level")
    keys = KeyRegistry(spark, scratch_path(spark, "ward-patients"), ["ward_id", "patient_id"])
    keys.register(stays.filter("triage_level = 1"))
    keys.register(stays)
    keys.register(stays)
    return keys.numbers()


@register("snk_03_fallback")
def q_snk_03(spark, d):
    """A table whose first place cannot be written, read from where it went instead."""
    root = scratch_path(spark, "fallback")
    used = publish.write_with_fallback(gb.gold_fact_pharmacy(spark, d), "nowhere://unknown/fact_pharmacy", f"{root}/fact_pharmacy")
    return spark.read.parquet(used)


@register("vs_20_guarded")
def q_vs_20(spark, d):
    """The stock suite under guard, and one that fails only while Spark runs its checks."""
    raw = tv.bronze_pharmacy(spark, d)
    broken = raw.withColumn("quantity", F.when(F.length("drug_id") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("quantity")).cast("string"))

    def suite(df, name):
        return lambda: results.suite_result(suites.validate_pharmacy(df, gb.LAB_AS_OF), df, name, gb.LAB_AS_OF, "pharmacy", 0.01, 0)

    out = results.guarded(suite(raw, "pharmacy"), "pharmacy", spark, gb.LAB_AS_OF).unionByName(results.guarded(suite(broken, "broken"), "broken", spark, gb.LAB_AS_OF))
    return out.select("table_name", "row_count", "issue_count", "warning_count", "passed", "quality_score")
