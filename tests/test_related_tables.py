"""Headers by file, marked cubes, guarded matrices, selections, dimensions and digests."""

import pytest
from pyspark.sql import functions as F

from tallyward.__main__ import main
from tallyward.functions.additive import rollup
from tallyward.functions.digest import table_digest
from tallyward.operators import cost, denial, enrich, utilization
from tallyward.operators.slicing import Selection
from tallyward.plans import marts, quality_metrics
from tallyward.plans.dashboard import dashboard
from tallyward.schemas import PATIENTS
from tallyward.sinks import files
from tallyward.sources import tables
from tests.fixtures import claims, patients


def _write(folder, name, header, *rows):
    folder.mkdir(exist_ok=True)
    lines = [",".join(header), *(",".join(str(row[column]) for column in header) for row in rows)]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def people(spark):
    return [row.asDict() for row in patients(spark, {"patient_id": 1}, {"patient_id": 2, "payer": "Aetna"}).collect()]


def test_every_file_has_its_own_header(spark, tmp_path, people):
    folder = tmp_path / "two words"
    _write(folder, "a.csv", PATIENTS.names, people[0])
    _write(folder, "b.csv", ['"extra"', *reversed(PATIENTS.names)], people[1] | {'"extra"': '"x, y"'})
    (folder / "empty.csv").write_text("")
    found = tables.read_table(spark, str(folder), "patients", strict=True)
    assert found.columns == PATIENTS.names
    assert sorted((row.asDict() for row in found.collect()), key=lambda row: row["patient_id"]) == people
    with pytest.raises(Exception, match="header"):
        tables.read_table(spark, str(folder), "patients", one_header=True).collect()


def test_a_file_without_a_column(spark, tmp_path, people):
    _write(tmp_path / "p", "a.csv", PATIENTS.names, people[0])
    _write(tmp_path / "p", "b.csv", [name for name in PATIENTS.names if name != "payer"], people[1])
    with pytest.raises(ValueError, match="payer"):
        tables.read_table(spark, str(tmp_path / "p"), "patients")


def test_one_header_for_equal_files(spark, tmp_path, people):
    for at, row in enumerate(people):
        _write(tmp_path / "p", f"{at}.csv", [*reversed(PATIENTS.names)], row)
    assert tables.read_table(spark, str(tmp_path / "p"), "patients", one_header=True).count() == 2


def test_claims_may_have_columns_called_like_blocks(spark, tmp_path):
    data = claims(spark, {"total_cost": 10}, {"claim_status": "Denied"}, {"region": "West"})
    odd = data.withColumns({"claims": F.lit(7), "denied": F.lit("no"), "cost_cents": F.lit(1.5)})
    for report in (utilization.utilization_matrix, cost.regional_cost, denial.denial_by_payer):
        assert sorted(report(odd).collect()) == sorted(report(data).collect())
    # A cube is known by its marks, also after a trip through files.
    rollup(odd, ["payer"], ["claims", "denied"]).write.parquet(str(tmp_path / "cube"))
    stored = spark.read.parquet(str(tmp_path / "cube"))
    assert sorted(denial.denial_by_payer(stored).collect()) == sorted(denial.denial_by_payer(data).collect())


def test_rest_counts_the_cells_without_a_column(spark):
    data = claims(spark, {"region": "West"}, {"region": "Atlantis"}, {"region": None}, {"region": "West"})
    row = utilization.utilization_matrix(data, ["West"], rest="rest").first()
    assert (row["West"], row["rest"]) == (2, 2)
    whole = utilization.utilization_matrix(data, rest="rest").first()
    assert (whole["West"], whole["Atlantis"], whole["null"], whole["rest"]) == (2, 1, 1, 0)
    named = utilization.utilization_matrix(data.union(claims(spark, {"region": "null"}))).first()
    assert (named["null"], named["null_"]) == (1, 1)
    assert utilization.utilization_matrix(data.limit(0)).columns == ["facility_type"]


def _selected(spark):
    data = claims(
        spark, {"patient_id": 1, "region": "West", "service_year": 2023}, {"patient_id": 2, "region": "West", "service_year": 2022},
        {"patient_id": 3, "region": "Midwest", "service_year": 2023},
    )
    known = patients(
        spark, *({"patient_id": n, "region": region} for n, region in enumerate(["West", "West", "Midwest", "West"], 1))
    )
    return data, known


def test_a_selection_reaches_the_patients(spark):
    data, known = _selected(spark)

    def kept(**chosen):
        selection = Selection(**chosen)
        found = selection.on_patients(known, marts.patient_cube(selection.on(data)))
        return sorted(row["patient_id"] for row in found.collect())

    assert kept() == [1, 2, 3, 4]
    assert kept(region=["West"]) == [1, 2, 4]  # also without claims
    assert kept(service_year=[2023]) == [1, 3]
    assert kept(service_year=[2023], region=["West"]) == [1]
    with pytest.raises(TypeError):
        Selection(colour=["red"])


def test_panels_under_a_selection(spark):
    data, known = _selected(spark)
    selection = Selection(service_year=[2023], region=["West"])
    cubes = files.build_cubes(data, selection)
    panels = dashboard(*cubes, known, selection=selection)
    assert panels["demographics_gender"].agg(F.sum("patients")).first()[0] == 1
    assert [row["region"] for row in panels["regional_cost"].collect()] == ["West"]
    values = {row["measure"]: row["value"] for row in panels["kpi_measures"].collect()}
    assert values["total_claims"] == 1 and values["spend_yoy_pct"] is not None  # the year before is not selected
    plain = dashboard(selection.on(data), marts.patient_cube(selection.on(data)), known, selection=selection)
    for name in ("kpi_summary", "readmission_matrix", "demographics_decades"):
        assert panels[name].collect() == plain[name].collect()


def test_a_stored_quality_table(spark):
    data, _ = _selected(spark)
    own = quality_metrics.quality_metrics(data)
    stored = own.withColumn("avg_los_hospital", F.lit(99.0))
    assert quality_metrics.matching(stored, data).agg(F.min("avg_los_hospital")).first()[0] == 99.0
    for wrong in (stored.filter("region = 'West'"), stored.union(stored), stored.withColumn("year", F.lit(1))):
        with pytest.raises(ValueError, match="differ"):
            quality_metrics.matching(wrong, data)


def test_the_job_uses_a_stored_quality_table(spark, tmp_path):
    data, known = _selected(spark)
    stored = quality_metrics.quality_metrics(data).withColumn("avg_los_hospital", F.lit(99.0))
    files.write_datasets({"claims": data, "patients": known, "quality_metrics": stored}, str(tmp_path / "in"))

    def stays(*arguments):
        main(["analyze", str(tmp_path / "in"), str(tmp_path / "out"), *arguments])
        return spark.read.parquet(f"{tmp_path}/out/panels/quality_stay_by_region").orderBy("region").collect()

    assert [tuple(row) for row in stays()] == [("Midwest", 99.0), ("West", 99.0)]
    assert [tuple(row) for row in stays("--region", "West")] == [("West", 99.0)]
    assert [row["patient_id"] for row in spark.read.parquet(f"{tmp_path}/out/marts/patient_level").collect()].count(3) == 0
    assert stays("--facility-type", "Hospital")[0]["avg_los"] != 99.0  # the stored table cannot be cut that way


def test_dimensions_as_tables(spark):
    data = claims(spark, {"diagnosis_code": "E11"}, {"diagnosis_code": "?"}, {"diagnosis_code": None})
    names = [("E11", "Sugar"), (None, "nothing"), ("X", "unused")]
    dimension = spark.createDataFrame(names, "diagnosis_code string, diagnosis_desc string")
    found = enrich.with_dimension(data, dimension, "diagnosis_code", "diagnosis_desc")
    assert found.columns == data.columns
    assert {row["diagnosis_code"]: row["diagnosis_desc"] for row in found.collect()} == {"E11": "Sugar", "?": None, None: None}
    double = dimension.union(dimension.limit(1))
    with pytest.raises(Exception, match="more than one row for diagnosis_code E11"):
        enrich.with_dimension(data, double, "diagnosis_code", "diagnosis_desc").collect()


def test_digests_tell_tables_apart(spark):
    table = spark.createDataFrame([(1, "a|b", 1.5), (2, None, None), (2, None, None)], "`x.y` int, s string, d double")
    whole = table_digest(table).first()
    assert whole == table_digest(table.orderBy(F.desc("s")).select("d", "`x.y`", "s")).first()
    assert whole["rows"] == 3
    others = [table.distinct(), table.union(table), table.withColumn("d", F.lit(1.5)), table.withColumn("s", F.lit("~"))]
    assert all(table_digest(other).first() != whole for other in others)
    assert tuple(table_digest(table.limit(0)).first()) == (0, 0, 0)
