"""Edge cases on hand-made rows."""

from datetime import date

import pytest

from tallyward.operators import (
    cost,
    denial,
    enrich,
    patients as people,
    quality,
    readmission,
    slicing,
    utilization,
)
from tallyward.plans import marts, measures, quality_metrics as quality_mart
from tallyward.schemas import CLAIMS, PATIENTS, REGIONS
from tallyward.sources import tables
from tests.fixtures import claims, patients, rows


def test_empty_claims(spark):
    none, people_ = spark.createDataFrame([], CLAIMS), patients(spark, {})
    assert rows(quality.qc_null_fields(none)) == [
        ("QC-01 Null critical fields", None, None, None, None)
    ]
    assert rows(quality.qc_overpayment(none)) == [("QC-03 Overpayment anomaly", 0, None)]
    report = rows(quality.qc_report(none, people_))
    assert [flagged for _, flagged, _ in report] == [0] * 10
    assert {status for _, _, status in report} == {"PASS"}
    assert rows(measures.exec_kpis(none)) == [(None, 0, None, None, None)]
    assert rows(utilization.monthly_volume(none)) == []


def test_report_order_and_labels(spark):
    report = quality.qc_report(
        claims(spark, {"region": "Atlantis"}), patients(spark, {}), labels=("ok", "look")
    )
    found = rows(report)
    assert [name[:5] for name, _, _ in found] == [f"QC-{n:02d}" for n in range(1, 11)]
    assert found[-1] == ("QC-10 Unknown region", 1, "look")
    assert rows(quality.qc_total_flags(report)) == [(1,)]


def test_null_is_not_an_unknown_value(spark):
    data = claims(spark, {"region": None, "readmission_30d": None})
    assert rows(quality.rule("unknown_region", data)) == [(0,)]
    assert rows(quality.rule("bad_flag", data)) == [(0,)]


def test_orphans_include_claims_without_a_patient(spark):
    data = claims(spark, {"patient_id": None}, {"patient_id": 9}, {"patient_id": 9}, {})
    assert rows(quality.qc_orphans(data, patients(spark, {}))) == [("QC-04 Orphaned claims", 3)]


def test_duplicate_groups_and_surplus_rows_differ(spark):
    data = claims(spark, {}, {}, {}, {"diagnosis_code": None}, {"diagnosis_code": None}, {"patient_id": 2})
    assert rows(quality.qc_duplicates(data)) == [("QC-06 Duplicate claims", 2)]
    assert rows(quality.rule("duplicates", data)) == [(3,)]


def test_nonpositive_rules_differ_on_negative_payments(spark):
    data = claims(spark, {"paid_amount": "-1.00"}, {"total_cost": "0.00", "paid_amount": "0.00"})
    assert rows(quality.qc_nonpositive(data)) == [("QC-02 Non-positive costs", 2)]
    assert rows(quality.rule("nonpositive_cost", data)) == [(1,)]


def test_future_is_relative_to_the_given_day(spark):
    data = claims(spark, {}, {"service_date": date(2023, 5, 18)})
    assert rows(quality.qc_future(data, as_of=date(2023, 5, 17))) == [("QC-07 Future-dated claims", 1)]
    assert rows(quality.qc_future(data)) == [("QC-07 Future-dated claims", 0)]


def test_patient_without_claims(spark):
    summary = people.patient_summary(claims(spark, {}), patients(spark, {}, {})).orderBy("patient_id")
    with_claims, without = summary.collect()
    assert with_claims.total_claims == 1 and with_claims.total_cost == 100.0
    assert without.total_claims == 0
    assert without.total_cost is without.avg_cost_per_claim is without.readmissions is None
    assert without.last_service_date is None


def test_age_band_edges(spark):
    ages = [17, 18, 29, 30, 80, 94, 95]
    people_ = patients(spark, *[{"age": age} for age in ages])
    data = claims(
        spark,
        *[{"patient_id": i, "total_cost": f"{age}.00"} for i, age in enumerate(ages, start=1)],
    )
    assert rows(people.cost_by_age_group(data, people_)) == [
        ("18-29", 23.5),
        ("30-39", 30.0),
        ("80+", 87.0),
    ]


def test_previous_row_skips_a_missing_year(spark):
    data = claims(
        spark,
        {"service_year": 2020, "total_cost": "100.00"},
        {"service_year": 2022, "total_cost": "110.00"},
        {"region": "Midwest", "service_year": 2022, "total_cost": "0.00"},
        {"region": "Midwest", "service_year": 2023, "total_cost": "5.00"},
    )
    assert rows(cost.yoy_cost(data)) == [
        ("Midwest", 2022, 0.0, None, None),
        ("Midwest", 2023, 5.0, 0.0, None),
        ("West", 2020, 100.0, None, None),
        ("West", 2022, 110.0, 100.0, 10.0),
    ]
    changes = rows(measures.yoy_avg_cost(marts.mart_regional_cost(data)))
    assert changes == [
        ("Midwest", 2022, 0.0, None),
        ("Midwest", 2023, 5.0, None),
        ("West", 2020, 100.0, None),
        ("West", 2022, 110.0, 0.1),
    ]


def test_spend_yoy_uses_the_calendar_year_before(spark):
    data = claims(
        spark,
        {"service_year": 2020, "total_cost": "100.00"},
        {"service_year": 2022, "total_cost": "110.00"},
        {"service_year": 2023, "total_cost": "220.00"},
    )
    summary = marts.mart_claims_summary(data)
    assert rows(measures.measure_spend_yoy(summary)) == [(2023, 0.00022, 0.00011, 100.0)]
    assert rows(measures.measure_spend_yoy(summary, years=[2020, 2022])) == [
        (2022, 0.00011, None, None)
    ]
    coarse = marts.summary_at(data, ["service_year"], ["total_spend"])
    assert rows(measures.measure_spend_yoy(coarse)) == rows(measures.measure_spend_yoy(summary))


def test_rank_is_dense_and_over_all_regions(spark):
    data = claims(
        spark,
        {"region": "West", "total_cost": "5.00"},
        {"region": "Midwest", "total_cost": "9.00"},
        {"region": "Northeast", "total_cost": "9.00"},
    )
    ranked = measures.region_cost_rank(marts.mart_claims_summary(data), regions=["West", "Midwest"])
    assert sorted(rows(ranked)) == [("Midwest", 9.0, 1), ("West", 5.0, 2)]


def test_zero_cost_has_no_coverage(spark):
    data = claims(spark, {"total_cost": "0.00", "paid_amount": "0.00", "patient_oop": "0.00"})
    assert rows(cost.cost_by_payer(data)) == [("Aetna", 1, 0.0, 0.0, 0.0, None)]


def test_means_ignore_missing_costs(spark):
    data = claims(spark, {}, {"total_cost": None, "paid_amount": None}, {"paid_amount": None})
    assert rows(cost.regional_cost(data)) == [("West", 3, 100.0, 100.0, 100.0, 200.0)]
    assert rows(quality.qc_null_fields(data))[0][3] == 1
    # One of the two billed claims has a payment, so the means are over different rows.
    assert rows(cost.payer_mix(data))[0][-1] == 75.0


def test_half_cents(spark):
    """Reports round half up, the quality mart rounds half to even."""
    for total, half_up, half_even in (("0.01", 0.01, 0.0), ("0.03", 0.02, 0.02), ("0.05", 0.03, 0.02)):
        data = claims(spark, {"total_cost": total}, {"total_cost": "0.00"})
        assert rows(cost.regional_yearly(data))[0][-1] == half_up
        assert quality_mart.quality_metrics(data).first().avg_cost_per_claim == half_even


def test_region_year_without_hospital_claims(spark):
    row = quality_mart.quality_metrics(claims(spark, {"facility_type": "ER"})).first()
    assert row.readmission_rate_pct == 0.0 and row.avg_los_hospital == 0.0
    assert row.er_visit_rate_pct == 100.0


def test_matrices_fill_gaps(spark):
    data = claims(spark, {"service_year": 2022}, {"region": "Midwest", "service_year": 2023})
    metrics = quality_mart.quality_metrics(data)
    assert sorted(rows(quality_mart.los_matrix(metrics))) == [("Midwest", 0.0, 2.0), ("West", 2.0, 0.0)]
    assert sorted(rows(readmission.readmit_matrix(data))) == [
        ("Midwest", None, 0.0),
        ("West", 0.0, None),
    ]
    counted = utilization.utilization_matrix(data, REGIONS)
    assert counted.columns == ["facility_type", *REGIONS]
    assert rows(counted) == [("Hospital", 0, 0, 1, 1, 0)]


def test_at_least_ten_stays(spark):
    nine = [{"diagnosis_code": "E11", "diagnosis_desc": "Type 2 Diabetes"}] * 9
    data = claims(spark, *nine, *[{}] * 10)
    assert [row.diagnosis_code for row in readmission.readmit_by_diagnosis(data).collect()] == ["I10"]
    assert [row.admits for row in readmission.top_readmit_diagnoses(data).collect()] == [10]


def test_ties_at_the_cut_are_ordered_by_code(spark):
    data = claims(spark, *[{"diagnosis_code": code} for code in ("Z51", "E11", "J45", "E11", "J45")])
    top = utilization.top_diagnoses(data, limit=2).collect()
    assert [row.diagnosis_code for row in top] == ["E11", "J45"]


@pytest.mark.parametrize(
    "denied, total, severity",
    [(3, 100, "ok"), (301, 10000, "warn"), (5, 100, "warn"), (501, 10000, "alert")],
)
def test_thresholds_are_exclusive(spark, denied, total, severity):
    data = claims(spark, {}).selectExpr(
        "payer", "claim_status", f"explode(sequence(1, {total})) AS n"
    ).selectExpr("payer", f"IF(n <= {denied}, 'Denied', 'Approved') AS claim_status")
    assert denial.denial_alert(data).first().severity == severity


def test_calendar_edges(spark):
    days = [date(2024, 2, 29), date(2023, 12, 31), date(2024, 1, 1)]
    enriched = enrich.enrich_calendar(
        claims(spark, *[{"service_date": day} for day in days]).select("service_date")
    )
    assert rows(enriched) == [
        (days[0], 2024, 2, "Q1"),
        (days[1], 2023, 12, "Q4"),
        (days[2], 2024, 1, "Q1"),
    ]
    span = spark.createDataFrame([(date(2022, 1, 1), date(2024, 12, 31))], "start date, end date")
    calendar = enrich.date_table(span)
    assert calendar.count() == 1096
    leap = calendar.filter("Date = '2024-02-29'").first()
    assert tuple(leap) == (days[0], 2024, "Q1", 2, "Feb", "2024-02")


def test_unknown_codes_and_payers(spark):
    data = claims(spark, {"diagnosis_code": "X99", "payer": "Nobody", "procedure_code": None})
    row = enrich.apply_rate_card(enrich.enrich_codes(data)).first()
    assert row.diagnosis_desc is None and row.procedure_desc is None
    assert row.paid_amount is None and row.patient_oop is None


def test_rate_card_rounds_half_up(spark):
    row = enrich.apply_rate_card(claims(spark, {"payer": "Medicaid", "total_cost": "0.10"})).first()
    assert (float(row.paid_amount), float(row.patient_oop)) == (0.07, 0.03)


def test_slicers(spark):
    data = claims(spark, {}, {"region": "Midwest"}, {"region": None})
    assert slicing.slice_rows(data, region=["West"], payer=None).count() == 1
    assert slicing.slice_rows(data.drop("payer"), skip_missing=True, payer=["nobody"]).count() == 3
    with pytest.raises(ValueError, match="no column"):
        slicing.slice_rows(data.drop("payer"), payer=["nobody"])
    by_year = data.withColumnRenamed("service_year", "year")
    assert slicing.slice_rows(by_year, service_year=[1900]).count() == 0
    assert slicing.slice_rows(data, region=[]).count() == 0
    with pytest.raises(ValueError):
        slicing.slice_rows(data, gender=["F"])


def test_coerce_schema(spark):
    text = spark.createDataFrame([("2023", "12.5", "x")], "service_year string, avg_cost string, claims string")
    lenient = tables.coerce_schema(text, lenient=True)
    assert lenient.dtypes == [("service_year", "bigint"), ("avg_cost", "double"), ("claims", "bigint")]
    assert rows(lenient) == [(2023, 12.5, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.coerce_schema(text).collect()


def test_declared_schema_keeps_leading_zeros(spark, tmp_path):
    patients(spark, {}).write.option("header", True).csv(str(tmp_path / "patients"))
    again = tables.read_table(spark, str(tmp_path / "patients"), "patients")
    assert again.schema == PATIENTS
    assert again.first().zip_code == "01234"


def test_malformed_rows_fail_the_read(spark, tmp_path):
    (tmp_path / "patients.csv").write_text(",".join(PATIENTS.names) + "\n1,old,F,West,Aetna,01234,1,2020-01-01\n")
    broken = tables.read_table(spark, str(tmp_path / "patients.csv"), "patients")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        broken.collect()
