"""Denied claims and claim status."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyward.functions.additive import rollup
from tallyward.functions.money import from_cents, percent
from tallyward.functions.shares import share_of_all


def denial_by_payer(claims: DataFrame) -> DataFrame:
    return (
        rollup(claims, ["payer"], ["claims", "denied"])
        .select(
            "payer",
            F.col("claims").alias("total_claims"),
            "denied",
            percent("denied", "claims").alias("denial_rate_pct"),
        )
        .orderBy(F.desc("denial_rate_pct"), "payer")
    )


def status_distribution(claims: DataFrame) -> DataFrame:
    """Claims, share and billed value per claim status."""
    return rollup(claims, ["claim_status"], ["claims", "cost_cents"]).select(
        "claim_status",
        "claims",
        share_of_all("claims").alias("pct"),
        from_cents("cost_cents").alias("value_at_risk"),
    )


def denial_alert(claims: DataFrame, alert: float = 5.0, warn: float = 3.0) -> DataFrame:
    """Denial rate per payer with a severity; both thresholds are exclusive."""
    rate = F.col("denial_rate_pct")
    severity = F.when(rate > alert, "alert").when(rate > warn, "warn").otherwise("ok")
    return denial_by_payer(claims).select("payer", rate, severity.alias("severity"))
