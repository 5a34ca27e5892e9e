"""Patient-level summary and demographics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyward.functions.additive import rollup
from tallyward.functions.money import cents, exact_mean_money, from_cents, mean_money
from tallyward.functions.shares import share_of_all
from tallyward.schemas import AGE_BANDS

_TRAITS = ["patient_id", "age", "gender", "region", "payer", "chronic_conditions"]
_COST = ["cost_cents", "cost_rows"]


def _attach(claims: DataFrame, patients: DataFrame, blocks: list[str], how: str) -> DataFrame:
    """Patients with their claims already reduced to one row per patient."""
    return patients.join(rollup(claims, ["patient_id"], blocks), "patient_id", how)


def patient_summary(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Every patient with their claim totals; without claims only the count is set."""
    blocks = [*_COST, "claim_ids", "oop_cents", "readmissions", "last_service_date"]
    return _attach(claims, patients.select(*_TRAITS), blocks, "left").select(
        *_TRAITS,
        F.coalesce("claim_ids", F.lit(0)).alias("total_claims"),
        from_cents("cost_cents").alias("total_cost"),
        mean_money("cost_cents", "cost_rows").alias("avg_cost_per_claim"),
        from_cents("oop_cents").alias("total_oop"),
        "readmissions",
        "last_service_date",
    )


def patient_level(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """The export form of the summary: counts, cost and readmissions only."""
    blocks = ["cost_cents", "claim_ids", "readmissions"]
    return _attach(claims, patients.select(*_TRAITS), blocks, "left").select(
        *_TRAITS,
        F.coalesce("claim_ids", F.lit(0)).alias("total_claims"),
        from_cents("cost_cents").alias("total_cost"),
        "readmissions",
    )


def register_patient_summary(
    spark: SparkSession, claims: DataFrame, patients: DataFrame
) -> DataFrame:
    """Expose the summary to SQL as `vw_patient_summary`."""
    summary = patient_summary(claims, patients)
    summary.createOrReplaceTempView("vw_patient_summary")
    return spark.table("vw_patient_summary")


def age_band(age: Column) -> Column:
    """Label of the left-closed band `age` falls in, NULL outside all bands."""
    (low, high, label), *rest = AGE_BANDS
    band = F.when((age >= low) & (age < high), label)
    for low, high, label in rest:
        band = band.when((age >= low) & (age < high), label)
    return band


def cost_by_age_group(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Mean claim cost per age band; only bands with claims appear."""
    aged = patients.select("patient_id", age_band(F.col("age")).alias("age_group"))
    grouped = _attach(claims, aged.filter("age_group IS NOT NULL"), _COST, "inner")
    return (
        rollup(grouped, ["age_group"], _COST)
        .select("age_group", exact_mean_money("cost_cents", "cost_rows").alias("avg_cost"))
        .orderBy("age_group")
    )


def cost_by_chronic(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Mean claim cost by number of chronic conditions."""
    grouped = _attach(claims, patients.select("patient_id", "chronic_conditions"), _COST, "inner")
    return (
        rollup(grouped, ["chronic_conditions"], _COST)
        .select("chronic_conditions", exact_mean_money("cost_cents", "cost_rows").alias("avg_cost"))
        .orderBy("chronic_conditions")
    )


def gender_mix(patients: DataFrame) -> DataFrame:
    """Patients per gender with their share."""
    return (
        patients.groupBy("gender")
        .agg(F.count(F.lit(1)).alias("patients"))
        .select("gender", "patients", share_of_all("patients").alias("pct"))
    )


def age_decades(patient_mart: DataFrame) -> DataFrame:
    """Mean patient cost per ten-year age bin of the patient-level mart."""
    decade = (F.floor(F.col("age") / 10) * 10).cast("int")
    return (
        patient_mart.groupBy(decade.alias("age_decade"))
        .agg(
            F.count(F.lit(1)).alias("patients"),
            exact_mean_money(F.sum(cents("total_cost")), F.count("total_cost")).alias(
                "avg_total_cost"
            ),
        )
        .orderBy("age_decade")
    )


def payer_region_cost(patient_mart: DataFrame) -> DataFrame:
    """Total cost per payer and region of the patient-level mart."""
    return patient_mart.groupBy("payer", "region").agg(
        from_cents(F.sum(cents("total_cost"))).alias("total_cost")
    )
