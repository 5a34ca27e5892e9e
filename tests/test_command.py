"""The two jobs of the command line, end to end on files."""

from datetime import date

from tallyward.__main__ import main
from tallyward.sinks import files
from tests.fixtures import claims, patients


def test_validate_and_analyze(spark, tmp_path, capsys):
    files.write_datasets(
        {
            "claims": claims(spark, {}, {}, {"patient_id": 5, "service_date": date(2024, 1, 1)}),
            "patients": patients(spark, {}, {}),
        },
        f"{tmp_path}/data",
    )
    main(["validate", f"{tmp_path}/data", f"{tmp_path}/out", "--as-of", "2023-12-31"])
    # One orphan, one surplus duplicate, one claim after the given day.
    assert "Total flagged records: 3" in capsys.readouterr().out
    main(["analyze", f"{tmp_path}/data", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out/marts/patient_level").count() == 2
    kpis = spark.read.parquet(f"{tmp_path}/out/panels/kpi_summary").first()
    assert (kpis.total_claims, kpis.total_spend) == (3, 300.0)
