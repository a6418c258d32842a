"""Quarantine (PRJ-05): one pass over raw rows, two outputs.

Rules name what makes a row unusable.  Every row is written once, with the codes of all rules it breaks, into the accepted or the
rejected side; both are then read from there, so the input is scanned and its values are parsed a single time, and
accepted and rejected rows together are the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import canonical_id, lenient_double, lenient_timestamp

REASONS, ACCEPTED = "reject_reasons", "_accepted"


@dataclass(frozen=True)
class Routed:
    """``accepted`` has the columns of the input, ``rejected`` these and ``reject_reasons``."""

    accepted: DataFrame
    rejected: DataFrame

    def summary(self) -> DataFrame:
        """``reason, rows``: rejected rows by reason; one with several counts under each."""
        return self.rejected.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def reasons(rules: dict[str, Column]) -> Column:
    """Codes of the rules that a row breaks, in the order given; a rule that gives NULL is not broken."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(code)) for code, broken in rules.items()]))


def route(df: DataFrame, rules: dict[str, Column], path: str) -> Routed:
    """Write ``df`` to ``path`` by the rules and read the two sides back."""
    marked = df.withColumn(REASONS, reasons(rules)).withColumn(ACCEPTED, F.size(REASONS) == 0)
    marked.write.partitionBy(ACCEPTED).parquet(path)
    # the partition column is cast so that a side without rows still has its schema
    read = df.sparkSession.read.schema(marked.schema).parquet(path)
    accepted = read.filter(F.col(ACCEPTED)).drop(ACCEPTED, REASONS)
    return Routed(accepted, read.filter(~F.col(ACCEPTED)).drop(ACCEPTED))


def _missing(name: str) -> Column:
    return canonical_id(name).isNull()


def _unreadable(name: str, read: Column) -> Column:
    """Something stands there, but it cannot be read."""
    return F.col(name).isNotNull() & (F.trim(name) != "") & read.isNull()


def lab_rules() -> dict[str, Column]:
    return {
        "no_result_id": _missing("lab_result_id"),
        "no_patient": _missing("patient_id"),
        "no_test": F.coalesce(F.trim("test_type"), F.lit("")) == "",
        "bad_test_date": _unreadable("test_date", lenient_timestamp("test_date")),
        "bad_result": _unreadable("result_value", lenient_double("result_value")),
    }


def pharmacy_rules() -> dict[str, Column]:
    return {
        "no_drug_id": _missing("drug_id"),
        "no_drug_name": F.coalesce(F.trim("drug_name"), F.lit("")) == "",
        "bad_quantity": _unreadable("quantity", lenient_double("quantity")),
        "bad_expiry": _unreadable("expiry_date", lenient_timestamp("expiry_date")),
    }


def admission_rules() -> dict[str, Column]:
    return {
        "no_admission_id": _missing("admission_id"),
        "no_patient": _missing("patient_id"),
        "bad_admission_date": _unreadable("admission_date", lenient_timestamp("admission_date")),
    }
