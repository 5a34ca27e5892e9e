"""What care costs: by payer, region and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyward.functions.additive import COST, rollup
from tallyward.functions.money import coverage, from_cents, mean_money, percent, ratio
from tallyward.functions.shares import share_of_all

_PAYMENT = [*COST, "paid_cents", "paid_rows", "oop_cents", "oop_rows"]
_MONTHS = ["service_year", "service_month"]


def cost_by_payer(claims: DataFrame) -> DataFrame:
    """Allowed, paid and out-of-pocket means per payer, and what the payer covers."""
    return (
        rollup(claims, ["payer"], _PAYMENT)
        .select(
            "payer",
            "claims",
            mean_money("cost_cents", "cost_rows").alias("avg_allowed"),
            mean_money("paid_cents", "paid_rows").alias("avg_paid"),
            mean_money("oop_cents", "oop_rows").alias("avg_oop"),
            coverage("paid_cents", "paid_rows", "cost_cents", "cost_rows").alias(
                "payer_coverage_pct"
            ),
        )
        .orderBy(F.desc("avg_allowed"), "payer")
    )


def payer_mix(claims: DataFrame) -> DataFrame:
    """The payers by claim volume, with their share of all claims."""
    return (
        rollup(claims, ["payer"], _PAYMENT)
        .select(
            "payer",
            "claims",
            share_of_all("claims").alias("claims_pct"),
            mean_money("cost_cents", "cost_rows").alias("avg_billed"),
            mean_money("paid_cents", "paid_rows").alias("avg_paid"),
            mean_money("oop_cents", "oop_rows").alias("avg_oop"),
            coverage("paid_cents", "paid_rows", "cost_cents", "cost_rows").alias("coverage_pct"),
        )
        .orderBy(F.desc("claims"), "payer")
    )


def regional_cost(claims: DataFrame) -> DataFrame:
    """Mean, extreme and total cost per region."""
    return (
        rollup(claims, ["region"], [*COST, "min_cents", "max_cents"])
        .select(
            "region",
            "claims",
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
            from_cents("min_cents").alias("min_cost"),
            from_cents("max_cents").alias("max_cost"),
            from_cents("cost_cents").alias("total_spend"),
        )
        .orderBy(F.desc("avg_cost"), "region")
    )


def cost_trend(claims: DataFrame) -> DataFrame:
    """Monthly mean, spend and volume with a sortable period label."""
    label = F.concat_ws(
        "-", F.col("service_year").cast("string"), F.lpad(F.col("service_month").cast("string"), 2, "0")
    )
    return (
        rollup(claims, _MONTHS, COST)
        .select(
            *_MONTHS,
            mean_money("cost_cents", "cost_rows").alias("avg_cost"),
            from_cents("cost_cents").alias("total_spend"),
            "claims",
            label.alias("period"),
        )
        .orderBy(*_MONTHS)
    )


def monthly_spend(claims: DataFrame) -> DataFrame:
    """Summed cost per month of service."""
    return (
        rollup(claims, _MONTHS, ["cost_cents"])
        .select(*_MONTHS, from_cents("cost_cents").alias("total_cost"))
        .orderBy(*_MONTHS)
    )


def regional_yearly(claims: DataFrame) -> DataFrame:
    """Mean cost per region and year."""
    return (
        rollup(claims, ["region", "service_year"], COST)
        .select("region", "service_year", mean_money("cost_cents", "cost_rows").alias("avg_cost"))
        .orderBy("region", "service_year")
    )


def yoy_cost(claims: DataFrame) -> DataFrame:
    """Mean cost per region and year against the region's previous row.

    The means are rounded to cents before they are compared.  The previous row is
    the previous year that has claims, not necessarily the previous calendar year.
    """
    by_year = Window.partitionBy("region").orderBy("service_year")
    mean = F.round(ratio("cost_cents", "cost_rows"), 0)
    return (
        rollup(claims, ["region", "service_year"], COST)
        .select("region", "service_year", mean.alias("current"))
        .withColumn("previous", F.lag("current").over(by_year))
        .select(
            "region",
            F.col("service_year").alias("year"),
            (F.col("current") / 100).alias("avg_cost"),
            (F.col("previous") / 100).alias("prev_year_cost"),
            percent(F.col("current") - F.col("previous"), "previous").alias("yoy_pct_change"),
        )
        .orderBy("region", "year")
    )
