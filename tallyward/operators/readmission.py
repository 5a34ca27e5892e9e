"""30-day readmissions; every report here looks at hospital claims only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyward.functions.additive import COST, rollup
from tallyward.functions.spread import spread
from tallyward.functions.money import mean_money, percent
from tallyward.schemas import HOSPITAL

_RATE = ["claims", "readmissions"]


def _hospital(claims: DataFrame) -> DataFrame:
    return claims.filter(F.col("facility_type") == HOSPITAL)


def _rate():
    return percent("readmissions", "claims")


def readmit_by_region(claims: DataFrame) -> DataFrame:
    return (
        rollup(_hospital(claims), ["region"], _RATE)
        .select(
            "region",
            F.col("claims").alias("hospital_claims"),
            "readmissions",
            _rate().alias("readmission_rate_pct"),
        )
        .orderBy(F.desc("readmission_rate_pct"), "region")
    )


def readmit_by_diagnosis(claims: DataFrame, min_admits: int = 10) -> DataFrame:
    """Rate and mean cost per diagnosis with at least `min_admits` stays."""
    diagnosis = ["diagnosis_code", "diagnosis_desc"]
    return (
        rollup(_hospital(claims), diagnosis, [*COST, "readmissions"])
        .filter(F.col("claims") >= min_admits)
        .select(
            *diagnosis,
            F.col("claims").alias("hospital_admits"),
            "readmissions",
            _rate().alias("readmission_rate_pct"),
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
        )
        .orderBy(F.desc("readmission_rate_pct"), "diagnosis_code")
    )


def readmit_by_year(claims: DataFrame) -> DataFrame:
    return (
        rollup(_hospital(claims), ["service_year"], _RATE)
        .select(
            "service_year",
            F.col("claims").alias("hospital_claims"),
            "readmissions",
            _rate().alias("readmission_rate_pct"),
        )
        .orderBy("service_year")
    )


def readmit_by_chronic(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Rate and mean cost by the patient's number of chronic conditions.

    Claims are reduced to one row per patient before they meet the patients, so
    a patient with very many claims weighs no more in the join than any other.
    """
    blocks = [*COST, "claim_ids", "readmissions"]
    per_patient = rollup(_hospital(claims), ["patient_id"], blocks)
    return (
        rollup(
            per_patient.join(patients.select("patient_id", "chronic_conditions"), "patient_id"),
            ["chronic_conditions"],
            blocks,
        )
        .select(
            "chronic_conditions",
            F.col("claim_ids").alias("hospital_claims"),
            "readmissions",
            _rate().alias("readmission_rate_pct"),
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
        )
        .orderBy("chronic_conditions")
    )


def top_readmit_diagnoses(
    claims: DataFrame, limit: int = 8, min_admits: int = 10
) -> DataFrame:
    """Diagnoses with the highest rate; equal rates are ordered by description."""
    return (
        rollup(_hospital(claims), ["diagnosis_desc"], _RATE)
        .filter(F.col("claims") >= min_admits)
        .select(
            "diagnosis_desc", _rate().alias("readmit_pct"), F.col("claims").alias("admits")
        )
        .orderBy(F.desc("readmit_pct"), "diagnosis_desc")
        .limit(limit)
    )


def readmit_matrix(
    claims: DataFrame, years: Sequence[int] | None = None, rest: str | None = None
) -> DataFrame:
    """Readmission rate by region (rows) and year (columns), NULL where no stays."""
    rates = rollup(_hospital(claims), ["region", "service_year"], _RATE).select(
        "region", "service_year", _rate().alias("readmit_pct")
    )
    return spread(rates, "region", "service_year", "readmit_pct", years, rest=rest)
