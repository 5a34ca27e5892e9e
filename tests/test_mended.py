"""Inputs that once went wrong without an error."""

import pytest
from pyspark.sql import functions as F

from tallyward.functions.additive import rollup
from tallyward.operators import percentiles, quality, readmission, utilization
from tallyward.plans import quality_metrics
from tallyward.schemas import PATIENTS
from tallyward.sources import tables
from tests.fixtures import claims, patients


def _varied(spark):
    return claims(
        spark, {"region": "West"}, {"region": "Atlantis"}, {"region": None},
        {"region": "West", "service_year": 2031}, {"region": "Atlantis", "service_year": 2031},
    )


def test_matrices_keep_every_claim(spark):
    data = _varied(spark)
    matrix = utilization.utilization_matrix(data)
    assert {"West", "Atlantis", "null"} <= set(matrix.columns)
    assert sum(sum(row[1:]) for row in matrix.collect()) == data.count()
    assert "2031" in readmission.readmit_matrix(data).columns
    metrics = quality_metrics.quality_metrics(data)
    assert "2031" in quality_metrics.los_matrix(metrics).columns
    with pytest.raises(ValueError, match="Atlantis"):
        utilization.utilization_matrix(data, ["West"])


def _csv(tmp_path, header, line):
    (tmp_path / "patients.csv").write_text(",".join(header) + "\n" + ",".join(line) + "\n")
    return str(tmp_path / "patients.csv")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    row = dict(zip(PATIENTS.names, map(str, patients(spark, {}).first()), strict=True))
    header = ["extra", *reversed(PATIENTS.names)]
    path = _csv(tmp_path, header, ["x", *reversed(list(row.values()))])
    found = tables.read_table(spark, path, "patients")
    assert found.columns == PATIENTS.names
    assert {name: str(value) for name, value in found.first().asDict().items()} == row


def test_csv_without_a_column(spark, tmp_path):
    with pytest.raises(ValueError, match="payer"):
        tables.read_table(spark, _csv(tmp_path, ["patient_id"], ["1"]), "patients")


def test_strict_reading_looks_at_every_column(spark, tmp_path):
    row = dict(zip(PATIENTS.names, map(str, patients(spark, {}).first()), strict=True)) | {"age": "abc"}
    path = _csv(tmp_path, list(row), list(row.values()))
    assert tables.read_table(spark, path, "patients").select("gender").count() == 1
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tables.read_table(spark, path, "patients", strict=True).select("gender").collect()


def test_a_cube_without_a_block_is_an_error(spark):
    cube = rollup(_varied(spark), ["region", "facility_type"], ["cost_cents"])
    with pytest.raises(ValueError, match="claims"):
        utilization.utilization_matrix(cube)


def _scans(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Relation [")


def test_the_report_reads_claims_once(spark, tmp_path):
    claims(spark, {}).write.parquet(str(tmp_path / "claims"))
    stored = spark.read.parquet(str(tmp_path / "claims"))
    assert _scans(quality.qc_report(stored, patients(spark, {}))) == 2  # claims and patients


def test_percentiles_read_claims_once(spark):
    reads = spark.sparkContext.accumulator(0)
    data = _varied(spark).rdd.map(lambda row: (reads.add(1), row)[1]).toDF(_varied(spark).schema)
    percentiles.cost_percentiles(data.select("region", F.col("total_cost"))).collect()
    assert reads.value == 5
