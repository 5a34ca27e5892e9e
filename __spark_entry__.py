"""

Every query reads the given tables through the claims model of
``tallyward.sources.testbed`` and asks it only for the columns it needs.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date
from functools import partial, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from oracle.statements import statements  # noqa: E402
from tallyward.functions import digest  # noqa: E402
from tallyward.operators import (  # noqa: E402
    cost,
    denial,
    enrich,
    patients as people,
    percentiles,
    quality,
    ranking,
    readmission,
    slicing,
    utilization,
)
from tallyward.plans import marts, measures, quality_metrics as quality_mart  # noqa: E402
from tallyward.schemas import CLAIMS, DIAGNOSES, PAID_SHARE, PROCEDURES, TABLES  # noqa: E402
from tallyward.session import materialize, scratch_path  # noqa: E402
from tallyward.sinks import files  # noqa: E402
from tallyward.sources import faults, tables, testbed  # noqa: E402

try:  # the package for training data may be left out
    import corpus_pipeline  # noqa: E402
    from tallyward.llm import queries as training_data  # noqa: E402
except ImportError:
    corpus_pipeline = training_data = None

AS_OF = date(2001, 6, 1)
SELECTION = {
    "service_year": [1997, 1998],
    "region": ["Northeast", "West"],
    "payer": ["Medicare", "Aetna"],
    "facility_type": ["Hospital", "ER"],
}

Query = Callable[[SparkSession, str], DataFrame]

_COST = "total_cost"
_SUMMARY = [*marts.SUMMARY_KEYS, "total_cost", "paid_amount", "readmission_30d"]
_PAYER = ["payer", "service_year", "total_cost", "paid_amount", "claim_status"]
_QUALITY = [
    "region", "service_year", "total_cost", "claim_status",
    "facility_type", "readmission_30d", "length_of_stay",
]
_REPORT = [
    "claim_id", "patient_id", "service_date", "diagnosis_code", "procedure_code", "region",
    "total_cost", "paid_amount", "length_of_stay", "readmission_30d",
]
_EXPORT = list(dict.fromkeys(["claim_id", "patient_id", *_SUMMARY, *_PAYER, *_QUALITY]))


def _on_claims(operator: Callable, *columns: str, **options) -> Query:
    """A query that feeds the named claim columns to `operator`."""
    return lambda spark, path: operator(testbed.claims(spark, path, columns), **options)


def _on_both(operator: Callable, columns: str, traits: str, **options) -> Query:
    """Like `_on_claims` with patient columns as the second argument."""
    return lambda spark, path: operator(
        testbed.claims(spark, path, columns.split()),
        testbed.patients(spark, path, traits.split()),
        **options,
    )


def _on_faulty(operator: Callable, *columns: str, **options) -> Query:
    """Like `_on_claims`, with faults laid over the claims."""
    return lambda spark, path: operator(
        faults.with_faults(testbed.claims(spark, path, ["claim_id", *columns])), **options
    )


def _rule(name: str, *columns: str) -> Query:
    return _on_faulty(lambda claims: quality.rule(name, claims, as_of=AS_OF), *columns)


def _with_people(spark: SparkSession, path: str) -> DataFrame:
    return testbed.patients(spark, path, ["patient_id"])


def _faulty_orphans(operator: Callable) -> Query:
    return lambda spark, path: operator(
        faults.with_faults(testbed.claims(spark, path, ["claim_id", "patient_id"])),
        _with_people(spark, path),
    )


def _report(spark: SparkSession, path: str, faulty: bool = True) -> DataFrame:
    claims = testbed.claims(spark, path, _REPORT)
    if faulty:
        claims = faults.with_faults(claims)
    return quality.qc_report(claims, _with_people(spark, path), as_of=AS_OF)


def _summary(spark: SparkSession, path: str) -> DataFrame:
    return marts.mart_claims_summary(testbed.claims(spark, path, _SUMMARY))


def _on_summary(operator: Callable, keys: str, measures_: str, needs: str, **options) -> Query:
    """A measure over the claims summary at the grain of `keys`."""
    return lambda spark, path: operator(
        marts.summary_at(
            testbed.claims(spark, path, [*keys.split(), *needs.split()]),
            keys.split(),
            measures_.split(),
        ),
        **options,
    )


def _on_payer_mart(operator: Callable) -> Query:
    return lambda spark, path: operator(
        marts.mart_payer_analysis(testbed.claims(spark, path, _PAYER))
    )


def _on_quality_mart(operator: Callable, **options) -> Query:
    return lambda spark, path: operator(
        quality_mart.quality_metrics(testbed.claims(spark, path, _QUALITY)), **options
    )


_TRAITS = "patient_id age gender region payer chronic_conditions"
_PATIENT_MART = _on_both(
    people.patient_level, "claim_id patient_id total_cost readmission_30d", _TRAITS
)


def _as_doubles(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, for a comparison that has one numeric type."""
    return frame.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


def _stored_metrics(spark: SparkSession, root: str, one_header: bool) -> DataFrame:
    """The quality table of claims stored below `root`, whose joins are not made again."""
    stored = tables.read_table(spark, f"{root}/claims", "claims", one_header=one_header)
    return quality_mart.quality_metrics(stored)


def _digests(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """A digest of each table's contents."""
    digests = [digest.table_digest(frame).select(F.lit(name).alias(key), "*") for name, frame in frames.items()]
    return reduce(DataFrame.unionByName, digests)


def _write_datasets(spark: SparkSession, path: str) -> DataFrame:
    root = scratch_path(spark, "datasets")
    files.write_datasets({"patients": testbed.patients(spark, path), "claims": testbed.claims(spark, path)}, root)
    files.write_datasets({"quality_metrics": _stored_metrics(spark, root, one_header=True)}, root)
    return _digests({name: tables.read_table(spark, f"{root}/{name}", name) for name in TABLES}, "table_name")


def _read_tables(spark: SparkSession, path: str) -> DataFrame:
    """CSV folders whose files have their columns in different orders, and one more column."""
    root = scratch_path(spark, "mixed")
    makers = {
        "patients": lambda: testbed.patients(spark, path),
        "claims": lambda: testbed.claims(spark, path),
        "quality_metrics": lambda: materialize(_stored_metrics(spark, root, one_header=False)),
    }
    for name, make in makers.items():
        frame = make()
        key = F.pmod(F.xxhash64(frame.columns[0]), F.lit(2))
        ways = (sorted(frame.columns), [*reversed(frame.columns), "source"])
        for way, columns in enumerate(ways):
            part = frame.withColumn("source", F.lit("b, c")).filter(key == way).select(*columns)
            part.write.mode("append").option("header", True).csv(f"{root}/{name}")
    return _digests(tables.read_tables(spark, root), "table_name")


def _register_tables(spark: SparkSession, path: str) -> DataFrame:
    tables.register_tables(
        {
            "patients": testbed.patients(spark, path, ["patient_id", "gender"]),
            "claims": testbed.claims(spark, path, ["patient_id", "total_cost"]),
            "quality_metrics": quality_mart.quality_metrics(
                testbed.claims(spark, path, _QUALITY)
            ),
        }
    )
    return spark.sql(
        """
        SELECT p.gender, count(*) AS claims, cast(sum(c.total_cost) AS double) AS total_cost,
               (SELECT sum(total_claims) FROM quality_metrics) AS all_claims
        FROM claims c JOIN patients p ON c.patient_id = p.patient_id
        GROUP BY p.gender
        """
    )


def _coerce_schema(spark: SparkSession, path: str) -> DataFrame:
    summary = _summary(spark, path)
    text = summary.select(*[F.col(name).cast("string").alias(name) for name in summary.columns])
    return tables.coerce_schema(text).withColumn("total_paid", F.col("total_paid").cast("double"))


def _write_qc_report(spark: SparkSession, path: str) -> DataFrame:
    target = scratch_path(spark, "qc-report")
    files.write_qc_report(_report(spark, path), target)
    schema = "check string, flagged_records bigint, status string"
    return spark.read.schema(schema).option("header", True).csv(target)


def _export(write: Callable, key: str, *columns: str, **selected) -> Query:
    """A query that writes tables and digests what it reads back."""

    def run(spark: SparkSession, path: str) -> DataFrame:
        root = scratch_path(spark, key)
        claims = testbed.claims(spark, path, [*_EXPORT, *columns])
        names = write(claims, testbed.patients(spark, path), root, selection=slicing.Selection(**selected))
        return _digests({name: spark.read.parquet(f"{root}/{name}") for name in names}, key)

    return run


_export_marts = partial(_export, files.export_marts, "mart")
_export_panels = partial(_export, files.export_dashboard, "panel", "service_month", "patient_oop")


def _store_claims(spark: SparkSession, path: str) -> DataFrame:
    target = scratch_path(spark, "claims")
    files.store_claims(testbed.claims(spark, path), target)
    stored = spark.read.schema(CLAIMS).parquet(target)
    chosen = slicing.slice_rows(stored, service_year=SELECTION["service_year"])
    return cost.monthly_spend(chosen)


def _patient_view(spark: SparkSession, path: str) -> DataFrame:
    people.register_patient_summary(
        spark,
        testbed.claims(spark, path, _VISITS.split()),
        testbed.patients(spark, path, _TRAITS.split()),
    )
    return spark.sql(
        """
        SELECT region, count(*) AS patients, sum(total_claims) AS total_claims,
               max(last_service_date) AS last_service_date
        FROM vw_patient_summary GROUP BY region
        """
    )


_VISITS = "claim_id patient_id total_cost patient_oop readmission_30d service_date"


def _slice_claims(spark: SparkSession, path: str) -> DataFrame:
    claims = testbed.claims(spark, path, ["claim_id", *slicing.SLICERS, "total_cost"])
    return _as_doubles(slicing.slice_rows(claims, **SELECTION))


def _sliced_kpis(spark: SparkSession, path: str) -> DataFrame:
    columns = [*slicing.SLICERS, "total_cost", "readmission_30d", "claim_status"]
    return measures.exec_kpis(
        slicing.slice_rows(testbed.claims(spark, path, columns), **SELECTION)
    )


def _chosen(*columns: str, enricher: Callable, keep: tuple[str, ...], faulty: bool = False) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        claims = testbed.claims(spark, path, columns)
        claims = faults.with_faults(claims) if faulty else claims
        return _as_doubles(enricher(claims).select(*columns, *keep))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Mean claim cost per region and year against the previous year."""
    return queries()["yoy_cost"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    month = ["service_year", "service_month", _COST]
    paid = ["payer", _COST, "paid_amount", "patient_oop"]
    stay = ["facility_type", "readmission_30d"]
    diagnosis = ["diagnosis_code", "diagnosis_desc"]
    identity = ["patient_id", "service_date", "diagnosis_code", "procedure_code"]
    found = {
        # enrichment
        "enrich_calendar": _chosen(
            "claim_id", "service_date", enricher=enrich.enrich_calendar,
            keep=("service_year", "service_month", "service_quarter"),
        ),
        "enrich_codes": _chosen(
            "claim_id", "diagnosis_code", "procedure_code", enricher=enrich.enrich_codes,
            keep=("diagnosis_desc", "procedure_desc"), faulty=True,
        ),
        "enrich_codes_table": lambda spark, path: _chosen(
            "claim_id", "diagnosis_code", "procedure_code", faulty=True, keep=("diagnosis_desc", "procedure_desc"),
            enricher=lambda claims: enrich.enrich_codes_from(
                claims,
                spark.createDataFrame(list(DIAGNOSES.items()), "diagnosis_code string, diagnosis_desc string"),
                spark.createDataFrame(list(PROCEDURES.items()), "procedure_code string, procedure_desc string"),
            ),
        )(spark, path),
        "apply_rate_table": lambda spark, path: _chosen(
            "claim_id", "payer", "total_cost", keep=("paid_amount", "patient_oop"),
            enricher=lambda claims: enrich.apply_rates_from(
                claims, spark.createDataFrame(list(PAID_SHARE.items()), "payer string, rate decimal(3,2)")
            ),
        )(spark, path),
        "apply_rate_card": _chosen(
            "claim_id", "payer", "total_cost", enricher=enrich.apply_rate_card,
            keep=("paid_amount", "patient_oop"),
        ),
        "date_table": _on_claims(
            lambda claims: enrich.date_table(enrich.service_range(claims)), "service_date"
        ),
        # filters
        "slice_claims": _slice_claims,
        "sliced_kpis": _sliced_kpis,
        "sliced_quality": _on_quality_mart(slicing.slice_rows, service_year=[1997]),
        # detailed quality checks
        "qc_null_fields": _on_faulty(
            quality.qc_null_fields, "patient_id", "service_date", _COST, "diagnosis_code"
        ),
        "qc_nonpositive": _on_faulty(quality.qc_nonpositive, _COST, "paid_amount"),
        "qc_overpayment": _on_faulty(quality.qc_overpayment, _COST, "paid_amount"),
        "qc_orphans": _faulty_orphans(quality.qc_orphans),
        "qc_long_stay": _on_faulty(quality.qc_long_stay, "length_of_stay"),
        "qc_duplicates": _on_faulty(quality.qc_duplicates, *identity),
        "qc_future": _on_faulty(quality.qc_future, "service_date", as_of=AS_OF),
        # report rules
        "rule_null_patient": _rule("null_patient", "patient_id"),
        "rule_null_date": _rule("null_date", "service_date"),
        "rule_nonpositive_cost": _rule("nonpositive_cost", _COST),
        "rule_overpaid": _rule("overpaid", _COST, "paid_amount"),
        "rule_orphans": _faulty_orphans(lambda c, p: quality.rule("orphans", c, p)),
        "rule_long_stay": _rule("long_stay", "length_of_stay"),
        "rule_duplicates": _rule("duplicates", *identity),
        "rule_future": _rule("future", "service_date"),
        "rule_bad_flag": _rule("bad_flag", "readmission_30d"),
        "rule_unknown_region": _rule("unknown_region", "region"),
        "qc_report": _report,
        "qc_report_clean": lambda spark, path: _report(spark, path, faulty=False),
        "qc_total_flags": lambda spark, path: quality.qc_total_flags(_report(spark, path)),
        # utilization
        "monthly_volume": _on_claims(utilization.monthly_volume, *month),
        "facility_utilization": _on_claims(
            utilization.facility_utilization, "facility_type", _COST
        ),
        "top_diagnoses": _on_claims(utilization.top_diagnoses, *diagnosis, _COST),
        "procedure_utilization": _on_claims(
            utilization.procedure_utilization, "procedure_code", "procedure_desc", _COST
        ),
        "utilization_matrix": _on_claims(
            utilization.utilization_matrix, "facility_type", "region", rest="rest"
        ),
        "utilization_matrix_faulty": _on_faulty(
            utilization.utilization_matrix, "facility_type", "region", rest="rest"
        ),
        # cost
        "cost_by_payer": _on_claims(cost.cost_by_payer, *paid),
        "regional_cost": _on_claims(cost.regional_cost, "region", _COST),
        "cost_percentiles": _on_claims(percentiles.cost_percentiles, "region", _COST),
        "high_cost_cohort": _on_claims(ranking.high_cost_cohort, "patient_id", _COST),
        "patient_ntile": _on_claims(ranking.patient_ntile, "patient_id", _COST),
        "payer_mix": _on_claims(cost.payer_mix, *paid),
        "yoy_cost": _on_claims(cost.yoy_cost, "region", "service_year", _COST),
        "cost_trend": _on_claims(cost.cost_trend, *month),
        "regional_yearly": _on_claims(cost.regional_yearly, "region", "service_year", _COST),
        "monthly_spend": _on_claims(cost.monthly_spend, *month),
        # readmission
        "readmit_by_region": _on_claims(readmission.readmit_by_region, "region", *stay),
        "readmit_by_diagnosis": _on_claims(
            readmission.readmit_by_diagnosis, *diagnosis, *stay, _COST
        ),
        "readmit_by_year": _on_claims(readmission.readmit_by_year, "service_year", *stay),
        "readmit_by_chronic": _on_both(
            readmission.readmit_by_chronic,
            "claim_id patient_id facility_type readmission_30d total_cost",
            "patient_id chronic_conditions",
        ),
        "top_readmit_diagnoses": _on_claims(
            readmission.top_readmit_diagnoses, "diagnosis_desc", *stay
        ),
        "readmit_matrix": _on_claims(
            readmission.readmit_matrix, "region", "service_year", *stay, rest="rest"
        ),
        # denial
        "denial_by_payer": _on_claims(denial.denial_by_payer, "payer", "claim_status"),
        "status_distribution": _on_claims(denial.status_distribution, "claim_status", _COST),
        "denial_alert": _on_claims(denial.denial_alert, "payer", "claim_status"),
        # patients
        "patient_summary": _on_both(people.patient_summary, _VISITS, _TRAITS),
        "patient_summary_view": _patient_view,
        "cost_by_age_group": _on_both(
            people.cost_by_age_group, "patient_id total_cost", "patient_id age"
        ),
        "cost_by_chronic": _on_both(
            people.cost_by_chronic, "patient_id total_cost", "patient_id chronic_conditions"
        ),
        "gender_mix": lambda spark, path: people.gender_mix(
            testbed.patients(spark, path, ["gender"])
        ),
        "age_decades": lambda spark, path: people.age_decades(_PATIENT_MART(spark, path)),
        "payer_region_cost": lambda spark, path: people.payer_region_cost(
            _PATIENT_MART(spark, path)
        ),
        # quality mart
        "quality_metrics": _on_claims(quality_mart.quality_metrics, *_QUALITY),
        "los_matrix": _on_quality_mart(quality_mart.los_matrix, rest="rest"),
        "er_matrix": _on_quality_mart(quality_mart.er_matrix, rest="rest"),
        "los_by_region": _on_quality_mart(quality_mart.los_by_region),
        # measures
        "exec_kpis": _on_claims(measures.exec_kpis, *stay, _COST, "claim_status"),
        "measure_spend_m": _on_summary(measures.measure_spend_m, "", "total_spend", _COST),
        "measure_claims": _on_summary(measures.measure_claims, "service_year", "claims", ""),
        "measure_avg_cost": _on_summary(
            measures.measure_avg_cost, "", "total_spend claims", _COST
        ),
        "measure_readmit_pct": _on_summary(
            measures.measure_readmit_pct, "", "readmissions claims", "readmission_30d"
        ),
        "measure_spend_yoy": _on_summary(
            measures.measure_spend_yoy, "service_year", "total_spend", _COST
        ),
        "measure_spend_yoy_selected": _on_summary(
            measures.measure_spend_yoy, "service_year", "total_spend", _COST, years=[1997, 1999]
        ),
        "region_cost_rank": _on_summary(
            measures.region_cost_rank, "region", "total_spend claims", _COST
        ),
        "region_cost_rank_selected": _on_summary(
            measures.region_cost_rank, "region", "total_spend claims", _COST,
            regions=["Midwest", "West"],
        ),
        "measure_denial_pct": _on_payer_mart(measures.measure_denial_pct),
        "yoy_avg_cost": lambda spark, path: measures.yoy_avg_cost(
            marts.mart_regional_cost(
                testbed.claims(spark, path, ["region", "service_year", _COST])
            )
        ),
        "cost_per_readmission": _on_summary(
            measures.cost_per_readmission, "", "total_spend readmissions", f"{_COST} readmission_30d"
        ),
        "payer_coverage": _on_payer_mart(measures.payer_coverage),
        "quarterly_kpis": lambda spark, path: measures.quarterly_kpis(_summary(spark, path)),
        "region_spend_vs_readmit": _on_summary(
            measures.region_spend_vs_readmit, "region", "total_spend readmissions claims",
            f"{_COST} readmission_30d",
        ),
        # marts
        "mart_claims_summary": _summary,
        "mart_regional_cost": _on_claims(
            marts.mart_regional_cost, "region", "service_year", _COST
        ),
        "mart_payer_analysis": _on_payer_mart(lambda mart: mart),
        "mart_readmissions": _on_claims(
            marts.mart_readmissions, *marts.READMISSION_KEYS, _COST, "readmission_30d"
        ),
        "mart_quality_metrics": _on_claims(marts.mart_quality_metrics, *_QUALITY),
        "mart_patient_level": _PATIENT_MART,
        # sources and sinks
        "read_tables": _read_tables,
        "register_tables": _register_tables,
        "coerce_schema": _coerce_schema,
        "store_claims": _store_claims,
        "write_qc_report": _write_qc_report,
        "export_marts": _export_marts(),
        "export_marts_sliced": _export_marts(**SELECTION),
        "export_dashboard": _export_panels(),
        "export_dashboard_sliced": _export_panels(**SELECTION),
        "write_datasets": _write_datasets,
    }
    if training_data is not None:
        found |= training_data.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The equivalent SQL over the raw tables for each query that SQL can express."""
    found = statements()
    if training_data is not None:
        found |= training_data.ORACLE_SQL
    return found
