"""How much care is used, where, and for what."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyward.functions.additive import COST, rollup
from tallyward.functions.spread import spread
from tallyward.functions.money import from_cents, mean_money
from tallyward.functions.shares import share_of_all


def monthly_volume(claims: DataFrame) -> DataFrame:
    """Claims, mean cost and spend per month of service."""
    months = ["service_year", "service_month"]
    return (
        rollup(claims, months, COST)
        .select(
            *months,
            F.col("claims").alias("total_claims"),
            mean_money("cost_cents", "cost_rows").alias("avg_claim_cost"),
            from_cents("cost_cents").alias("total_spend"),
        )
        .orderBy(*months)
    )


def facility_utilization(claims: DataFrame) -> DataFrame:
    """Claims per facility type with their share of all claims."""
    return (
        rollup(claims, ["facility_type"], COST)
        .select(
            "facility_type",
            F.col("claims").alias("claim_count"),
            share_of_all("claims").alias("pct_of_total"),
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
            from_cents("cost_cents").alias("total_spend"),
        )
        .orderBy(F.desc("claim_count"), "facility_type")
    )


def top_diagnoses(claims: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent diagnoses; equal counts are ordered by code."""
    return (
        rollup(claims, ["diagnosis_code", "diagnosis_desc"], COST)
        .orderBy(F.desc("claims"), "diagnosis_code", "diagnosis_desc")
        .limit(limit)
        .select(
            "diagnosis_code",
            "diagnosis_desc",
            F.col("claims").alias("claim_count"),
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
            from_cents("cost_cents").alias("total_cost"),
        )
    )


def procedure_utilization(claims: DataFrame) -> DataFrame:
    """How often each procedure was performed and its mean cost."""
    return (
        rollup(claims, ["procedure_code", "procedure_desc"], COST)
        .select(
            "procedure_code",
            "procedure_desc",
            F.col("claims").alias("times_performed"),
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
        )
        .orderBy(F.desc("times_performed"), "procedure_code")
    )


def utilization_matrix(
    claims: DataFrame, regions: Sequence[str] | None = None, rest: str | None = None
) -> DataFrame:
    """Claim counts by facility type (rows) and region (columns), 0 where none.

    All regions present get a column, unknown and NULL ones too; for `rest` see `spread`.
    """
    counts = rollup(claims, ["facility_type", "region"], ["claims"])
    return spread(counts, "facility_type", "region", "claims", regions, 0, rest)
