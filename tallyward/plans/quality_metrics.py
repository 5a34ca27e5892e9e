"""The region-by-year quality mart and the views on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyward.functions.additive import COST, rollup
from tallyward.functions.spread import spread
from tallyward.functions.money import (
    cents,
    from_cents,
    mean_half_even,
    percent_half_even,
    ratio,
)
from tallyward.schemas import QUALITY_METRICS

BLOCKS = [
    *COST,
    "denied",
    "er_claims",
    "hospital_readmissions",
    "hospital_flags",
    "hospital_days",
    "hospital_stays",
]


def quality_metrics(claims: DataFrame) -> DataFrame:
    """One row per region and year of service that has claims."""
    return present(rollup(claims, ["region", "service_year"], BLOCKS))


def present(blocks: DataFrame) -> DataFrame:
    """Round the blocks of one (region, service_year) frame into the mart.

    Readmissions and stay length cover hospital claims and are 0 without any.
    """
    readmission = percent_half_even("hospital_readmissions", "hospital_flags")
    stay = mean_half_even("hospital_days", "hospital_stays")
    return blocks.select(
        "region",
        F.col("service_year").alias("year"),
        F.col("claims").alias("total_claims"),
        mean_half_even("cost_cents", "cost_rows", scale=100).alias("avg_cost_per_claim"),
        from_cents("cost_cents").alias("total_spend"),
        F.coalesce(readmission, F.lit(0.0)).alias("readmission_rate_pct"),
        percent_half_even("denied", "claims").alias("denial_rate_pct"),
        F.coalesce(stay, F.lit(0.0)).alias("avg_los_hospital"),
        percent_half_even("er_claims", "claims").alias("er_visit_rate_pct"),
    )


def matching(stored: DataFrame, claims: DataFrame) -> DataFrame:
    """A stored quality table, if its regions and years are those of the claims."""
    ours = rollup(claims, ["region", "service_year"], ["claims"]).select(
        "region", F.col("service_year").alias("year"), F.lit(1).alias("side")
    )
    sides = ours.unionByName(stored.select("region", "year", F.lit(2).alias("side")))
    unlike = sides.groupBy("region", "year").agg(F.sort_array(F.collect_list("side")).alias("sides"))
    found = unlike.filter(F.col("sides") != F.array(F.lit(1), F.lit(2))).limit(5).collect()
    if found:
        rows = [f"{row['region']} {row['year']}" for row in found]
        raise ValueError(f"the quality table and the claims differ at {', '.join(rows)}")
    return stored.select(*QUALITY_METRICS.names)


def yearly_matrix(
    metrics: DataFrame, measure: str, years: Sequence[int] | None = None, rest: str | None = None
) -> DataFrame:
    """`measure` by region (rows) and year (columns), 0 where there is no row."""
    return spread(metrics, "region", "year", measure, years, 0.0, rest)


def los_matrix(
    metrics: DataFrame, years: Sequence[int] | None = None, rest: str | None = None
) -> DataFrame:
    return yearly_matrix(metrics, "avg_los_hospital", years, rest)


def er_matrix(
    metrics: DataFrame, years: Sequence[int] | None = None, rest: str | None = None
) -> DataFrame:
    return yearly_matrix(metrics, "er_visit_rate_pct", years, rest)


def los_by_region(metrics: DataFrame) -> DataFrame:
    """Mean of the yearly stay lengths per region, every year weighing the same."""
    hundredths = F.sum(cents("avg_los_hospital"))
    return (
        metrics.groupBy("region")
        .agg(ratio(hundredths, F.count("avg_los_hospital") * 100).alias("avg_los"))
        .orderBy("region")
    )
