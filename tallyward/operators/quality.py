"""Data-quality rules: the seven detailed checks and the ten-row report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallyward.functions.money import cents, mean_money
from tallyward.schemas import LONG_STAY_DAYS, REGIONS

_CLAIM_IDENTITY = ["patient_id", "service_date", "diagnosis_code", "procedure_code"]

# Names of the checks, in report order.
DETAILED_CHECKS = {
    "null_fields": "QC-01 Null critical fields",
    "nonpositive": "QC-02 Non-positive costs",
    "overpayment": "QC-03 Overpayment anomaly",
    "orphans": "QC-04 Orphaned claims",
    "long_stay": "QC-05 LOS > 30 days (review)",
    "duplicates": "QC-06 Duplicate claims",
    "future": "QC-07 Future-dated claims",
}
REPORT_CHECKS = {
    "null_patient": "QC-01 Null patient_id",
    "null_date": "QC-02 Null service_date",
    "nonpositive_cost": "QC-03 Non-positive total_cost",
    "overpaid": "QC-04 Paid > billed (overpayment)",
    "orphans": "QC-05 Orphaned claims",
    "long_stay": "QC-06 LOS > 30 days",
    "duplicates": "QC-07 Duplicate (patient+date+diag+proc)",
    "future": "QC-08 Future-dated claims",
    "bad_flag": "QC-09 Invalid readmission flag",
    "unknown_region": "QC-10 Unknown region",
}
# End of fixed values.


def _today(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def _named(check: str) -> Column:
    return F.lit(DETAILED_CHECKS[check]).alias("check_name")


def _orphans(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Number of claims of unknown patients.

    Counted per patient before the join: neither a NULL nor any other id with
    very many claims can overload a task.
    """
    per_patient = claims.groupBy("patient_id").agg(F.count(F.lit(1)).alias("n"))
    unknown = per_patient.join(patients.select("patient_id"), "patient_id", "left_anti")
    return unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("flagged_records"))


def _duplicate_groups(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy(*_CLAIM_IDENTITY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    )


def _surplus_rows(claims: DataFrame) -> DataFrame:
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return _duplicate_groups(claims).agg(surplus.alias("flagged_records"))


def _row_rules(as_of: date | None) -> dict[str, Column]:
    """Rules that look at one claim at a time."""
    return {
        "null_patient": F.col("patient_id").isNull(),
        "null_date": F.col("service_date").isNull(),
        "nonpositive_cost": F.col("total_cost") <= 0,
        "overpaid": F.col("paid_amount") > F.col("total_cost"),
        "long_stay": F.col("length_of_stay") > LONG_STAY_DAYS,
        "future": F.col("service_date") > _today(as_of),
        "bad_flag": ~F.col("readmission_30d").isin(0, 1),
        "unknown_region": ~F.col("region").isin(REGIONS),
    }


# --- detailed checks -------------------------------------------------------


def qc_null_fields(claims: DataFrame) -> DataFrame:
    """NULLs per critical field; NULL counts for an empty table."""

    def nulls(column: str) -> Column:
        return F.sum(F.when(F.col(column).isNull(), 1).otherwise(0))

    return claims.agg(
        nulls("patient_id").alias("null_patient_id"),
        nulls("service_date").alias("null_service_date"),
        nulls("total_cost").alias("null_total_cost"),
        nulls("diagnosis_code").alias("null_diag_code"),
    ).select(_named("null_fields"), "*")


def _count_where(claims: DataFrame, check: str, condition: Column) -> DataFrame:
    counted = claims.filter(condition).agg(F.count(F.lit(1)).alias("records_flagged"))
    return counted.select(_named(check), "records_flagged")


def qc_nonpositive(claims: DataFrame) -> DataFrame:
    condition = (F.col("total_cost") <= 0) | (F.col("paid_amount") < 0)
    return _count_where(claims, "nonpositive", condition)


def qc_overpayment(claims: DataFrame) -> DataFrame:
    """Claims paid above their billed cost, and by how much on average."""
    excess = cents("paid_amount") - cents("total_cost")
    return (
        claims.filter(F.col("paid_amount") > F.col("total_cost"))
        .agg(
            F.count(F.lit(1)).alias("records_flagged"),
            mean_money(F.sum(excess), F.count(F.lit(1))).alias("avg_overpayment"),
        )
        .select(_named("overpayment"), "*")
    )


def qc_orphans(claims: DataFrame, patients: DataFrame) -> DataFrame:
    return _orphans(claims, patients).select(
        _named("orphans"), F.col("flagged_records").alias("records_flagged")
    )


def qc_long_stay(claims: DataFrame) -> DataFrame:
    return _count_where(claims, "long_stay", F.col("length_of_stay") > LONG_STAY_DAYS)


def qc_duplicates(claims: DataFrame) -> DataFrame:
    """Number of groups of claims that agree on patient, date and both codes."""
    groups = _duplicate_groups(claims).agg(F.count(F.lit(1)).alias("duplicate_groups"))
    return groups.select(_named("duplicates"), "duplicate_groups")


def qc_future(claims: DataFrame, as_of: date | None = None) -> DataFrame:
    return _count_where(claims, "future", F.col("service_date") > _today(as_of))


# --- report rules ----------------------------------------------------------


def rule(
    name: str, claims: DataFrame, patients: DataFrame | None = None, as_of: date | None = None
) -> DataFrame:
    """One rule of the report as a single `flagged_records` row."""
    if name == "orphans":
        return _orphans(claims, patients)
    if name == "duplicates":
        return _surplus_rows(claims)
    return claims.agg(F.count_if(_row_rules(as_of)[name]).alias("flagged_records"))


def qc_report(
    claims: DataFrame,
    patients: DataFrame,
    as_of: date | None = None,
    labels: tuple[str, str] = ("PASS", "FLAG"),
) -> DataFrame:
    """All ten rules, one row each, with `labels` for clean and flagged.

    Claims are read once: they are counted per identity, which shows duplicates, then
    per patient, and only those counts meet the patients.
    """
    rules = _row_rules(as_of)
    counts = [F.count_if(condition).alias(name) for name, condition in rules.items()]
    by_identity = claims.groupBy(*_CLAIM_IDENTITY).agg(F.count(F.lit(1)).alias("n"), *counts)
    by_patient = by_identity.groupBy("patient_id").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        *[F.sum(name).alias(name) for name in rules],
    )
    known = patients.select("patient_id").distinct().withColumn("known", F.lit(True))
    orphans = F.when(F.col("known").isNull(), F.col("n")).otherwise(0).alias("orphans")
    joined = by_patient.join(known, "patient_id", "left").select("*", orphans)
    totals = joined.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in REPORT_CHECKS]
    )
    pairs = [part for name in REPORT_CHECKS for part in (F.lit(REPORT_CHECKS[name]), F.col(name))]
    report = totals.select(F.stack(F.lit(len(REPORT_CHECKS)), *pairs).alias("check", "flagged_records"))
    passed, flagged = labels
    status = F.when(F.col("flagged_records") == 0, passed).otherwise(flagged)
    return report.withColumn("status", status).orderBy("check")


def qc_total_flags(report: DataFrame) -> DataFrame:
    return report.agg(F.sum("flagged_records").alias("total_flagged"))
