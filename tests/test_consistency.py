"""Relations that must hold between queries on the same claims."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tallyward.plans import marts
from tallyward.sinks import files
from tallyward.sources import tables, testbed


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    return lambda name: queries()[name](spark, sf_dir)


def _sum(frame, column):
    return frame.agg(F.sum(column)).first()[0]


def test_summary_adds_up_to_the_headline(result):
    kpis, summary = result("exec_kpis").first(), result("mart_claims_summary")
    assert _sum(summary, "claims") == kpis.total_claims
    assert _sum(summary, F.rint(F.col("total_spend") * 100)) == round(kpis.total_spend * 100)


def test_shares_add_up(result):
    for name, column in (
        ("status_distribution", "pct"),
        ("facility_utilization", "pct_of_total"),
        ("payer_mix", "claims_pct"),
        ("gender_mix", "pct"),
    ):
        assert _sum(result(name), column) == pytest.approx(100, abs=0.05)


def test_matrix_cells_count_every_claim(result):
    matrix = result("utilization_matrix")
    cells = sum(F.col(name) for name in matrix.columns[1:])
    assert _sum(matrix, cells) == result("exec_kpis").first().total_claims


def test_readmissions_agree(result):
    assert _sum(result("mart_readmissions"), "readmissions") == _sum(
        result("readmit_by_region"), "readmissions"
    )


def test_duplicates_agree(result):
    groups = result("qc_duplicates").first().duplicate_groups
    surplus = result("rule_duplicates").first().flagged_records
    assert surplus > groups > 0


def test_every_rule_has_something_to_flag(result):
    assert {row.status for row in result("qc_report").collect()} == {"FLAG"}


def test_report_equals_single_rules(result):
    report = [row.flagged_records for row in result("qc_report").collect()]
    names = [
        "null_patient", "null_date", "nonpositive_cost", "overpaid", "orphans",
        "long_stay", "duplicates", "future", "bad_flag", "unknown_region",
    ]
    assert report == [result(f"rule_{name}").first().flagged_records for name in names]
    assert result("qc_total_flags").first().total_flagged == sum(report)


def test_top_tile_is_the_cohort(result):
    cohort = result("high_cost_cohort").first()
    top = result("patient_ntile").filter("tile = 1")
    assert top.count() == cohort.patient_count
    assert _sum(top, F.rint(F.col("total_patient_cost") * 100)) == round(cohort.cohort_spend * 100)


def test_exported_marts_equal_the_queries(spark, sf_dir, result, tmp_path):
    claims, patients = testbed.claims(spark, sf_dir), testbed.patients(spark, sf_dir)
    for kind in ("parquet", "csv"):
        root = f"{tmp_path}/{kind}"
        assert set(files.export_marts(claims, patients, root, csv=kind == "csv")) == {
            "claims_summary", "regional_cost", "payer_analysis",
            "readmissions", "quality_metrics", "patient_level",
        }
        for name in ("claims_summary", "patient_level"):
            expected = result(f"mart_{name}")
            reader = spark.read.schema(expected.schema).option("header", True)
            found = reader.format(kind).load(f"{root}/{name}")
            assert found.count() == expected.count()
            assert found.exceptAll(expected).isEmpty()


def test_csv_round_trip(spark, sf_dir, tmp_path):
    claims = testbed.claims(spark, sf_dir)
    written = {
        "patients": testbed.patients(spark, sf_dir),
        "claims": claims,
        "quality_metrics": marts.mart_quality_metrics(claims),
    }
    files.write_datasets(written, str(tmp_path))
    for name, frame in tables.read_tables(spark, str(tmp_path)).items():
        assert frame.dtypes == written[name].dtypes
        assert frame.exceptAll(written[name]).isEmpty()
        assert frame.count() == written[name].count()
