"""Profiling, integrity and validation-suite queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lab_ranges import classify
from ..functions.parse import lenient_double, lenient_timestamp
from ..operators import gold, profile
from ..quality import results, suites
from ..sources import testviews as tv
from . import gold_build as gb
from .catalog import register

# ---------------------------------------------------------------- keys and duplicates (lineitem line keys)


def _lines(spark, d):
    return tv.table(spark, d, "lineitem")


@register("agg_08_duplicate_groups")
def q_agg_08(spark, d):
    return profile.duplicate_groups(_lines(spark, d), ["l_orderkey", "l_linenumber"])


@register("agg_09_duplicate_rows")
def q_agg_09(spark, d):
    return profile.surplus_duplicates(tv.bronze_pharmacy(spark, d), "drug_id")


@register("agg_10_key_uniqueness")
def q_agg_10(spark, d):
    return profile.key_uniqueness(gb.silver_patients_dirty(spark, d), "patient_id")


# ---------------------------------------------------------------- distributions


@register("agg_11_distribution")
def q_agg_11(spark, d):
    return profile.value_distribution(tv.pharmacy_inventory(spark, d), "category")


@register("agg_12_rare_values")
def q_agg_12(spark, d):
    return profile.rare_values(tv.admissions(spark, d), "patient_id")


@register("top_01_top_wards")
def q_top_01(spark, d):
    return profile.top_k(tv.admissions(spark, d), "ward_id", 10)


@register("set_02_unknown_categories")
def q_set_02(spark, d):
    return profile.unknown_values(tv.bronze_pharmacy(spark, d), "category", suites.KNOWN_DRUG_CATEGORIES)


@register("agg_23_distinct_sample")
def q_agg_23(spark, d):
    return profile.distinct_sample(tv.pharmacy_inventory(spark, d), "drug_name", 5)


@register("lim_01_extract_limit")
def q_lim_01(spark, d):
    return profile.extract_limit(tv.patients(spark, d), 1000, ["patient_id"])


# ---------------------------------------------------------------- statistics


@register("agg_13_date_range")
def q_agg_13(spark, d):
    return profile.date_range(tv.admissions(spark, d), "admission_time")


@register("agg_14_quantity")
def q_agg_14(spark, d):
    return profile.quantity_stats(tv.bronze_pharmacy(spark, d), lenient_double("quantity"))


@register("agg_15_result_statistics")
def q_agg_15(spark, d):
    return profile.result_statistics(tv.lab_results(spark, d), "result_value")


@register("agg_16_tests_per_day")
def q_agg_16(spark, d):
    return profile.tests_per_day(tv.bronze_lab_results(spark, d), lenient_timestamp("test_date"))


@register("agg_17_distinct_counts")
def q_agg_17(spark, d):
    return profile.distinct_counts(tv.bronze_lab_results(spark, d), ["patient_id", "test_type"])


@register("agg_22_average_age")
def q_agg_22(spark, d):
    return profile.average_age(tv.patients(spark, d), "date_of_birth", gb.ADM_AS_OF)


@register("agg_18_reference_ranges")
def q_agg_18(spark, d):
    labs = tv.lab_results(spark, d)
    return profile.class_statistics(labs, "test_type", "result_value")


@register("agg_19_outliers")
def q_agg_19(spark, d):
    # the values are scaled per class so that outliers exist in the test data
    labs = tv.lab_results(spark, d).withColumn("x", F.when(F.col("result_value") > 480, F.col("result_value") * 100).otherwise(F.col("result_value")))
    return profile.class_outliers(labs, "test_type", "x")


@register("fn_17_test_classes")
def q_fn_17(spark, d):
    labs = tv.bronze_lab_results(spark, d)
    return labs.groupBy(classify("test_type").alias("range_name")).agg(F.count(F.lit(1)).alias("tests"))


@register("agg_24_same_time_tests")
def q_agg_24(spark, d):
    labs = tv.bronze_lab_results(spark, d).select("patient_id", lenient_timestamp("test_date").alias("t"))
    return profile.same_time_groups(labs, "patient_id", "t")


@register("win_01_test_interval")
def q_win_01(spark, d):
    labs = tv.bronze_lab_results(spark, d).select("lab_result_id", "patient_id", lenient_timestamp("test_date").alias("t"))
    return profile.test_intervals(labs, "patient_id", "t", tiebreak=["lab_result_id"]).select(
        "lab_result_id", "patient_id", "t", "previous_test_time", "days_since_previous"
    )


@register("win_01_frequent_tests")
def q_win_01b(spark, d):
    labs = tv.bronze_lab_results(spark, d).select("patient_id", lenient_timestamp("test_date").alias("t"))
    return profile.frequent_tests(labs, "patient_id", "t")


# ---------------------------------------------------------------- integrity


@register("jn_06_referential_integrity")
def q_jn_06(spark, d):
    fact = gold.fact_admissions(gb.silver_admissions_dirty(spark, d), gb.ADM_AS_OF)
    dim_p = gold.dim_patient(gb.silver_patients_dirty(spark, d), gb.ADM_AS_OF)
    dim_w = gold.dim_ward(gb.silver_wards_dirty(spark, d), gb.ADM_AS_OF)
    return results.referential_integrity(fact, dim_p, dim_w)


# ---------------------------------------------------------------- validation suites


@register("vs_01_patients")
def q_vs_01(spark, d):
    return suites.validate_patients(tv.bronze_patients(spark, d), gb.ADM_AS_OF)


@register("vs_02_admissions")
def q_vs_02(spark, d):
    return suites.validate_admissions(tv.bronze_admissions(spark, d), gb.ADM_AS_OF)


@register("vs_03_discharges")
def q_vs_03(spark, d):
    return suites.validate_discharges(tv.bronze_discharges(spark, d), gb.ADM_AS_OF)


@register("vs_04_wards")
def q_vs_04(spark, d):
    return suites.validate_wards(tv.bronze_wards(spark, d), gb.ADM_AS_OF)


@register("vs_06_pharmacy")
def q_vs_06(spark, d):
    return suites.validate_pharmacy(tv.bronze_pharmacy(spark, d), gb.LAB_AS_OF)


@register("vs_08_labs")
def q_vs_08(spark, d):
    return suites.validate_lab_results(tv.bronze_lab_results(spark, d), gb.LAB_AS_OF)


@register("vs_11_14_silver")
def q_vs_11(spark, d):
    return (
        suites.validate_silver("patients", gb.silver_patients_dirty(spark, d), gb.ADM_AS_OF)
        .unionByName(suites.validate_silver("admissions", gb.silver_admissions_dirty(spark, d), gb.ADM_AS_OF))
        .unionByName(suites.validate_silver("pharmacy_inventory", gb.silver_pharmacy_dirty(spark, d), gb.LAB_AS_OF))
        .unionByName(suites.validate_silver("lab_results", gb.silver_labs_dirty(spark, d), gb.LAB_AS_OF))
    )


def _dirty_gold(spark, d):
    sp = gb.silver_patients_dirty(spark, d)
    sa = gb.silver_admissions_dirty(spark, d)
    dim_p = gold.dim_patient(sp, gb.ADM_AS_OF)
    fact_a = gold.fact_admissions(sa, gb.ADM_AS_OF)
    fact_p = gold.fact_pharmacy(gb.silver_pharmacy_dirty(spark, d), gb.LAB_AS_OF)
    summ = gold.patient_summary(dim_p, gold.admissions_per_patient(fact_a), gb.ADM_AS_OF)
    daily = gold.daily_admissions_summary(fact_a)
    return dim_p, fact_a, fact_p, summ, daily


@register("vs_15_17_gold")
def q_vs_15(spark, d):
    dim_p, fact_a, fact_p, summ, daily = _dirty_gold(spark, d)
    return (
        suites.validate_gold("dim_patient", dim_p)
        .unionByName(suites.validate_gold("fact_admissions", fact_a))
        .unionByName(suites.validate_gold("fact_pharmacy", fact_p))
        .unionByName(suites.validate_gold("patient_summary", summ))
        .unionByName(suites.validate_gold("daily_admissions_summary", daily))
    )


def _suite_results(spark, d):
    """The four extract suites and their results; the independent plans are
    built from driver threads (plan construction waits on the JVM)."""
    from concurrent.futures import ThreadPoolExecutor

    specs = [
        ("patients", tv.bronze_patients, suites.validate_patients, gb.ADM_AS_OF, "records", 0.05),
        ("admissions", tv.bronze_admissions, suites.validate_admissions, gb.ADM_AS_OF, "records", 0.05),
        ("pharmacy", tv.bronze_pharmacy, suites.validate_pharmacy, gb.LAB_AS_OF, "pharmacy", 0.01),
        ("lab_results", tv.bronze_lab_results, suites.validate_lab_results, gb.LAB_AS_OF, "labs", 0.05),
    ]

    def one(spec):
        name, view, validate, as_of, rule, ratio = spec
        df = view(spark, d)
        return results.suite_result(validate(df, as_of), df, name, as_of, rule, ratio, 0)

    with ThreadPoolExecutor(max_workers=4) as pool:
        return list(pool.map(one, specs))


@register("vs_09_suite_results")
def q_vs_09(spark, d):
    out = _suite_results(spark, d)
    allr = out[0]
    for r in out[1:]:
        allr = allr.unionByName(r)
    return allr.select("table_name", "row_count", "issue_count", "warning_count", "passed", "quality_score")


@register("vs_19_rollup")
def q_vs_19(spark, d):
    return results.rollup(_suite_results(spark, d)).select("all_passed", F.array_join("failed_tables", ",").alias("failed_tables"), "tables_checked")


# ---------------------------------------------------------------- suite metrics


@register("vs_01_metrics")
def q_vs_01_metrics(spark, d):
    from ..quality import metrics

    return metrics.patient_metrics(tv.bronze_patients(spark, d), gb.ADM_AS_OF)


@register("vs_02_metrics")
def q_vs_02_metrics(spark, d):
    from ..quality import metrics

    return metrics.admission_metrics(tv.bronze_admissions(spark, d))


@register("vs_06_metrics")
def q_vs_06_metrics(spark, d):
    from ..quality import metrics

    return metrics.pharmacy_metrics(tv.bronze_pharmacy(spark, d), gb.LAB_AS_OF)


@register("vs_08_summary")
def q_vs_08_summary(spark, d):
    from ..quality import metrics

    return metrics.lab_summary(tv.bronze_lab_results(spark, d))
