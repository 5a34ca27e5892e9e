"""The six export marts.

Five of them are roll-ups of claims by a few categories, the sixth is one row per
patient.  Each takes raw claims, or a cube in their place: one cube by category
and one by patient serve everything, so claims are scanned twice in all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyward.functions.additive import COST, rollup
from tallyward.functions.money import from_cents, mean_money, percent
from tallyward.operators.patients import patient_level
from tallyward.plans import quality_metrics as quality
from tallyward.schemas import HOSPITAL

SUMMARY_KEYS = [
    "service_year",
    "service_quarter",
    "region",
    "payer",
    "facility_type",
    "diagnosis_desc",
]
SUMMARY_BLOCKS = [*COST, "paid_cents", "readmissions"]
REGIONAL_KEYS = ["region", "service_year"]
PAYER_KEYS = ["payer", "service_year"]
PAYER_BLOCKS = [*COST, "paid_cents", "paid_rows", "denied"]
READMISSION_KEYS = ["region", "service_year", "diagnosis_desc", "facility_type"]
READMISSION_BLOCKS = [*COST, "readmissions"]

# Summary columns that may be summed further: the block behind each, and its form.
_ADDITIVE = {
    "claims": ("claims", F.col),
    "total_spend": ("cost_cents", from_cents),
    "total_paid": ("paid_cents", from_cents),
    "readmissions": ("readmissions", F.col),
}

MART_BLOCKS = list(dict.fromkeys([*SUMMARY_BLOCKS, *PAYER_BLOCKS, *quality.BLOCKS]))


def claims_cube(
    claims: DataFrame,
    keys: Sequence[str] = SUMMARY_KEYS,
    blocks: Sequence[str] = MART_BLOCKS,
) -> DataFrame:
    """The blocks of all category marts at the grain of `keys`.

    Its size is bounded by the number of category combinations, not by claims.
    """
    return rollup(claims, keys, blocks)


def patient_cube(claims: DataFrame) -> DataFrame:
    """The blocks behind the patient mart and the demographic reports."""
    return rollup(claims, ["patient_id"], ["claim_ids", "cost_cents", "cost_rows", "readmissions"])


def _present_summary(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        *SUMMARY_KEYS,
        "claims",
        mean_money("cost_cents", "cost_rows").alias("avg_cost"),
        from_cents("cost_cents").alias("total_spend"),
        from_cents("paid_cents").alias("total_paid"),
        "readmissions",
        percent("readmissions", "claims").alias("readmit_pct"),
    )


def _present_regional(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        *REGIONAL_KEYS,
        "claims",
        mean_money("cost_cents", "cost_rows").alias("avg_cost"),
        from_cents("cost_cents").alias("total_spend"),
    )


def _present_payer(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        *PAYER_KEYS,
        "claims",
        mean_money("cost_cents", "cost_rows").alias("avg_billed"),
        mean_money("paid_cents", "paid_rows").alias("avg_paid"),
        percent("denied", "claims").alias("denial_rate_pct"),
    )


def _present_readmissions(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        *READMISSION_KEYS,
        F.col("claims").alias("admits"),
        "readmissions",
        percent("readmissions", "claims").alias("readmit_pct"),
        mean_money("cost_cents", "cost_rows").alias("avg_cost"),
    )


def mart_claims_summary(claims: DataFrame) -> DataFrame:
    return _present_summary(rollup(claims, SUMMARY_KEYS, SUMMARY_BLOCKS))


def summary_at(claims: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Additive columns of the claims summary at a coarser grain.

    A measure that only sums such columns gives the same result at any grain that
    keeps its own keys, so it need not pay for the others, nor for the joins
    behind them.
    """
    blocks = [_ADDITIVE[name][0] for name in columns]
    return rollup(claims, keys, blocks).select(
        *keys, *[_ADDITIVE[name][1](_ADDITIVE[name][0]).alias(name) for name in columns]
    )


def mart_regional_cost(claims: DataFrame) -> DataFrame:
    return _present_regional(rollup(claims, REGIONAL_KEYS, COST))


def mart_payer_analysis(claims: DataFrame) -> DataFrame:
    return _present_payer(rollup(claims, PAYER_KEYS, PAYER_BLOCKS))


def mart_readmissions(claims: DataFrame) -> DataFrame:
    stays = claims.filter(F.col("facility_type") == HOSPITAL)
    return _present_readmissions(rollup(stays, READMISSION_KEYS, READMISSION_BLOCKS))


def mart_quality_metrics(claims: DataFrame) -> DataFrame:
    return quality.quality_metrics(claims)


def mart_patient_level(claims: DataFrame, patients: DataFrame) -> DataFrame:
    return patient_level(claims, patients)


def all_marts(
    cube: DataFrame, per_patient: DataFrame, patients: DataFrame, metrics: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The six marts from the two cubes; `metrics` is a quality table to pass on instead."""
    return {
        "claims_summary": mart_claims_summary(cube),
        "regional_cost": mart_regional_cost(cube),
        "payer_analysis": mart_payer_analysis(cube),
        "readmissions": mart_readmissions(cube),
        "quality_metrics": mart_quality_metrics(cube) if metrics is None else metrics,
        "patient_level": mart_patient_level(per_patient, patients),
    }
