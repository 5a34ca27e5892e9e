"""Business measures over claims and over the export marts.

Measures take already sliced frames.  Those that look beyond the current
selection take the frame without that filter plus the selected values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyward.functions.additive import COST, rollup
from tallyward.functions.money import (
    cents,
    exact_mean_money,
    from_cents,
    percent,
    ratio,
)


def _sum_cents(column: str) -> Column:
    return F.sum(cents(column))


def _selected(column: str, values: Iterable | None) -> Column:
    return F.lit(True) if values is None else F.col(column).isin(list(values))


def exec_kpis(claims: DataFrame) -> DataFrame:
    """The headline numbers: readmissions among hospital claims, denials among all."""
    blocks = [*COST, "hospital_readmissions", "hospital_flags", "denied"]
    return rollup(claims, [], blocks).select(
        from_cents("cost_cents").alias("total_spend"),
        F.col("claims").alias("total_claims"),
        exact_mean_money("cost_cents", "cost_rows").alias("avg_cost"),
        ratio(F.col("hospital_readmissions") * 100, "hospital_flags").alias("readmit_rate"),
        ratio(F.col("denied") * 100, "claims").alias("denial_rate"),
    )


def measure_spend_m(summary: DataFrame) -> DataFrame:
    """Spend in millions."""
    return summary.agg((_sum_cents("total_spend").cast("double") / 100_000_000).alias("spend_m"))


def measure_claims(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("claims").alias("total_claims"))


def measure_avg_cost(summary: DataFrame) -> DataFrame:
    """Spend per claim, weighted by claims."""
    mean = exact_mean_money(_sum_cents("total_spend"), F.sum("claims"))
    return summary.agg(mean.alias("avg_cost_per_claim"))


def measure_readmit_pct(summary: DataFrame) -> DataFrame:
    """Readmissions per claim of any facility, in percent."""
    rate = ratio(F.sum("readmissions") * 100, F.sum("claims"))
    return summary.agg(rate.alias("readmission_rate_pct"))


def measure_spend_yoy(summary: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Spend of the latest selected year against the calendar year before, in percent.

    `summary` must not be filtered by year: the year before may lie outside the
    selection.  NULL when it has no spend.
    """
    yearly = summary.groupBy("service_year").agg(_sum_cents("total_spend").alias("spend"))
    latest = F.max(F.when(_selected("service_year", years), F.col("service_year")))
    compared = yearly.withColumn("latest", latest.over(Window.partitionBy()))

    def spend_of(offset: int) -> Column:
        return F.sum(F.when(F.col("service_year") == F.col("latest") - offset, F.col("spend")))

    return compared.agg(
        F.max("latest").alias("year"),
        spend_of(0).alias("current"),
        spend_of(1).alias("previous"),
    ).select(
        "year",
        (F.col("current").cast("double") / 100_000_000).alias("spend_m"),
        (F.col("previous").cast("double") / 100_000_000).alias("prev_spend_m"),
        ratio((F.col("current") - F.col("previous")) * 100, "previous").alias("spend_yoy_pct"),
    )


def region_cost_rank(summary: DataFrame, regions: Iterable[str] | None = None) -> DataFrame:
    """Dense rank of the selected regions by spend per claim among all regions.

    `summary` must not be filtered by region.
    """
    cost = exact_mean_money(_sum_cents("total_spend"), F.sum("claims"))
    by_cost = Window.orderBy(F.desc("avg_cost_per_claim"))
    return (
        summary.groupBy("region")
        .agg(cost.alias("avg_cost_per_claim"))
        .withColumn("cost_rank", F.dense_rank().over(by_cost))
        .filter(_selected("region", regions))
    )


def measure_denial_pct(payer_mart: DataFrame) -> DataFrame:
    """Share of claims in payer-years with any denial, in percent.

    This is not the rate of denied claims; see `denial_by_payer` for that.
    """
    in_denying = F.sum(F.when(F.col("denial_rate_pct") > 0, F.col("claims")))
    return payer_mart.agg(ratio(in_denying * 100, F.sum("claims")).alias("denial_rate_pct"))


def yoy_avg_cost(regional_mart: DataFrame) -> DataFrame:
    """Relative change of the mean cost against the region's previous row.

    A fraction; a missing mean counts as 0, and there is no change from 0.
    """
    by_year = Window.partitionBy("region").orderBy("service_year")
    return (
        regional_mart.groupBy("region", "service_year")
        .agg(F.coalesce(_sum_cents("avg_cost"), F.lit(0)).alias("current"))
        .withColumn("previous", F.lag("current").over(by_year))
        .select(
            "region",
            "service_year",
            from_cents("current").alias("avg_cost"),
            ratio(F.col("current") - F.col("previous"), F.abs("previous")).alias("yoy_change"),
        )
        .orderBy("region", "service_year")
    )


def cost_per_readmission(summary: DataFrame) -> DataFrame:
    cost = exact_mean_money(_sum_cents("total_spend"), F.sum("readmissions"))
    return summary.agg(cost.alias("cost_per_readmission"))


def payer_coverage(payer_mart: DataFrame) -> DataFrame:
    """Summed mean paid over summed mean billed; payer-years weigh the same."""
    share = ratio(_sum_cents("avg_paid") * 100, _sum_cents("avg_billed"))
    return payer_mart.agg(share.alias("payer_coverage_pct"))


def quarterly_kpis(summary: DataFrame) -> DataFrame:
    """Executive tiles per quarter; the mean cost is over summary rows."""
    quarter = ["service_year", "service_quarter"]
    return (
        summary.groupBy(*quarter)
        .agg(
            from_cents(_sum_cents("total_spend")).alias("total_spend"),
            F.sum("claims").alias("claims"),
            exact_mean_money(_sum_cents("avg_cost"), F.count("avg_cost")).alias("avg_cost"),
            F.sum("readmissions").alias("readmissions"),
        )
        .orderBy(*quarter)
    )


def region_spend_vs_readmit(summary: DataFrame) -> DataFrame:
    """Spend, readmission rate and volume per region."""
    return (
        summary.groupBy("region")
        .agg(
            from_cents(_sum_cents("total_spend")).alias("total_spend"),
            percent(F.sum("readmissions"), F.sum("claims")).alias("readmit_pct"),
            F.sum("claims").alias("claims"),
        )
        .orderBy("region")
    )
