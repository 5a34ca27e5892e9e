"""The data behind the dashboard panels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyward.operators import cost, denial, patients as people, readmission, utilization
from tallyward.operators.slicing import Selection
from tallyward.plans import marts, measures, quality_metrics as quality
from tallyward.plans.marts import MART_BLOCKS, SUMMARY_KEYS

PANEL_KEYS = [*SUMMARY_KEYS, "service_month"]
PANEL_BLOCKS = [*MART_BLOCKS, "oop_cents", "oop_rows", "min_cents", "max_cents"]
#: Slicers that some measure looks beyond; the category cube is not filtered by them.
CONTEXT = ("service_year", "region")


def headline_measures(claims: DataFrame, all_years: DataFrame) -> DataFrame:
    """One row per business measure: its name and value."""
    totals = marts.summary_at(claims, [], ["total_spend", "claims", "readmissions"])
    yearly = marts.summary_at(all_years, ["service_year"], ["total_spend"])
    latest = marts.summary_at(claims, ["service_year"], ["claims"]).agg(F.max("service_year")).first()[0]
    payers = marts.mart_payer_analysis(claims)
    rows = {
        "spend_m": measures.measure_spend_m(totals),
        "total_claims": measures.measure_claims(totals),
        "avg_cost_per_claim": measures.measure_avg_cost(totals),
        "readmission_rate_pct": measures.measure_readmit_pct(totals),
        "spend_yoy_pct": measures.measure_spend_yoy(yearly, [latest]),
        "denial_rate_pct": measures.measure_denial_pct(payers),
        "payer_coverage_pct": measures.payer_coverage(payers),
        "cost_per_readmission": measures.cost_per_readmission(totals),
    }
    named = [
        frame.select(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")) for name, frame in rows.items()
    ]
    return reduce(DataFrame.unionByName, named)


def dashboard(
    claims: DataFrame,
    per_patient: DataFrame,
    patients: DataFrame,
    metrics: DataFrame | None = None,
    selection: Selection | None = None,
) -> dict[str, DataFrame]:
    """Every panel's table by name.

    `claims` and `per_patient` are raw claims or, to scan claims only twice, the
    cubes with `PANEL_KEYS` and `PANEL_BLOCKS` and by patient.  `metrics` is a
    quality table to use instead of the one computed from the claims.

    Under a `selection`, `per_patient` is of the selected claims, and `claims` need not
    be: a year's change and a region's rank look beyond the year and the region.
    """
    selection = selection or Selection()
    whole, claims = claims, selection.on(claims)
    patients = selection.on_patients(patients, per_patient)
    if metrics is None:
        metrics = quality.quality_metrics(claims)
    level = people.patient_level(per_patient, patients)
    spending = ["total_spend", "claims", "readmissions"]
    all_regions = marts.summary_at(selection.on(whole, ["region"]), ["region"], spending)
    return {
        "kpi_summary": measures.exec_kpis(claims),
        "kpi_measures": headline_measures(claims, selection.on(whole, ["service_year"])),
        "kpi_quarterly": measures.quarterly_kpis(marts.mart_claims_summary(claims)),
        "kpi_monthly_spend": cost.monthly_spend(claims),
        "regional_cost": cost.regional_cost(claims),
        "regional_rank": measures.region_cost_rank(all_regions, selection.region),
        "regional_change": measures.yoy_avg_cost(marts.mart_regional_cost(claims)),
        "regional_spend_vs_readmission": measures.region_spend_vs_readmit(
            marts.summary_at(claims, ["region"], spending)
        ),
        "readmission_by_region": readmission.readmit_by_region(claims),
        "readmission_by_diagnosis": readmission.top_readmit_diagnoses(claims),
        "readmission_by_year": readmission.readmit_by_year(claims),
        "readmission_matrix": readmission.readmit_matrix(claims),
        "payer_mix": cost.payer_mix(claims),
        "utilization_heatmap": utilization.utilization_matrix(claims),
        "cost_trend": cost.cost_trend(claims),
        "cost_trend_regional": cost.regional_yearly(claims),
        "denial_rates": denial.denial_alert(claims),
        "quality_stay_length": quality.los_matrix(metrics),
        "quality_stay_by_region": quality.los_by_region(metrics),
        "quality_er_visits": quality.er_matrix(metrics),
        "demographics_age": people.cost_by_age_group(per_patient, patients),
        "demographics_decades": people.age_decades(level),
        "demographics_payer_region": people.payer_region_cost(level),
        "demographics_chronic": people.cost_by_chronic(per_patient, patients),
        "demographics_gender": people.gender_mix(patients),
    }
