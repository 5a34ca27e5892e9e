"""Reports on claims full of NULLs, against plain SQL without the cents rules.

The SQL divides and rounds in floating point, so amounts may differ by the last
digit; groups, counts and NULLs may not.
"""

import random
from datetime import date, timedelta

import duckdb
import pytest

from tallyward.operators import cost, denial, patients as people, percentiles, readmission, utilization
from tallyward.plans import marts, measures, quality_metrics as quality_mart
from tallyward.schemas import DIAGNOSES, FACILITY_TYPES, PAID_SHARE, PROCEDURES, REGIONS
from tests.fixtures import claims, patients


def _maybe(value):
    return None if random.random() < 0.1 else value


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    random.seed(3)
    changes = []
    for _ in range(1500):
        day = date(2020, 1, 1) + timedelta(days=random.randrange(1500))
        code = random.choice(list(DIAGNOSES))
        changes.append(
            {
                "patient_id": _maybe(random.randrange(1, 80)),
                "service_date": _maybe(day),
                "service_year": _maybe(day.year),
                "service_month": day.month,
                "diagnosis_code": _maybe(code),
                "diagnosis_desc": _maybe(DIAGNOSES[code]),
                "procedure_code": _maybe(random.choice(list(PROCEDURES))),
                "facility_type": _maybe(random.choice(FACILITY_TYPES)),
                "region": _maybe(random.choice(REGIONS)),
                "payer": _maybe(random.choice(list(PAID_SHARE))),
                "total_cost": _maybe(f"{random.randrange(10**6) / 100:.2f}"),
                "paid_amount": _maybe(f"{random.randrange(10**6) / 100:.2f}"),
                "patient_oop": _maybe(f"{random.randrange(10**6) / 100:.2f}"),
                "length_of_stay": _maybe(random.randrange(15)),
                "readmission_30d": _maybe(random.randrange(2)),
                "claim_status": _maybe(random.choice(["Approved", "Denied", "Pending"])),
            }
        )
    traits = [
        {"age": random.randrange(10, 100), "chronic_conditions": random.randrange(6)} for _ in range(90)
    ]
    frames = claims(spark, *changes), patients(spark, *traits)
    root = tmp_path_factory.mktemp("nulls")
    with duckdb.connect() as connection:
        for name, frame in zip(("claims", "patients"), frames):
            frame.write.parquet(f"{root}/{name}")
            connection.execute(f"CREATE TABLE {name} AS SELECT * FROM '{root}/{name}/*.parquet'")
        yield (*[spark.read.parquet(f"{root}/{name}") for name in ("claims", "patients")], connection)


_RATE = "100.0 * sum(readmission_30d) / count(*)"
_DENIED = "sum(CASE WHEN claim_status = 'Denied' THEN 1 ELSE 0 END)"
_SHARE = "100.0 * count(*) / sum(count(*)) OVER ()"
CASES = {
    "monthly_volume": (
        lambda c, p: utilization.monthly_volume(c),
        "SELECT service_year, service_month, count(*), avg(total_cost), sum(total_cost) FROM claims GROUP BY 1, 2",
    ),
    "facility_utilization": (
        lambda c, p: utilization.facility_utilization(c),
        f"SELECT facility_type, count(*), {_SHARE}, avg(total_cost), sum(total_cost) FROM claims GROUP BY 1",
    ),
    "procedure_utilization": (
        lambda c, p: utilization.procedure_utilization(c),
        "SELECT procedure_code, procedure_desc, count(*), avg(total_cost) FROM claims GROUP BY 1, 2",
    ),
    "cost_by_payer": (
        lambda c, p: cost.cost_by_payer(c),
        """SELECT payer, count(*), avg(total_cost), avg(paid_amount), avg(patient_oop),
                  round(100.0 * avg(paid_amount) / nullif(avg(total_cost), 0), 1) FROM claims GROUP BY 1""",
    ),
    "regional_cost": (
        lambda c, p: cost.regional_cost(c),
        """SELECT region, count(*), avg(total_cost), min(total_cost), max(total_cost), sum(total_cost)
           FROM claims GROUP BY 1""",
    ),
    "cost_percentiles": (
        lambda c, p: percentiles.cost_percentiles(c),
        """SELECT region, quantile_cont(total_cost::DOUBLE, 0.25), quantile_cont(total_cost::DOUBLE, 0.5),
                  quantile_cont(total_cost::DOUBLE, 0.75), quantile_cont(total_cost::DOUBLE, 0.9),
                  avg(total_cost) FROM claims GROUP BY 1""",
    ),
    "yoy_cost": (
        lambda c, p: cost.yoy_cost(c),
        """SELECT region, service_year, a, lag(a) OVER w, 100.0 * (a - lag(a) OVER w) / lag(a) OVER w
           FROM (SELECT region, service_year, round(avg(total_cost), 2) AS a FROM claims GROUP BY 1, 2)
           WINDOW w AS (PARTITION BY region ORDER BY service_year NULLS FIRST)""",
    ),
    "readmit_by_region": (
        lambda c, p: readmission.readmit_by_region(c),
        f"""SELECT region, count(*), sum(readmission_30d), {_RATE} FROM claims
            WHERE facility_type = 'Hospital' GROUP BY 1""",
    ),
    "readmit_by_chronic": (
        lambda c, p: readmission.readmit_by_chronic(c, p),
        f"""SELECT chronic_conditions, count(claim_id), sum(readmission_30d), {_RATE}, avg(total_cost)
            FROM claims JOIN patients USING (patient_id) WHERE facility_type = 'Hospital' GROUP BY 1""",
    ),
    "denial_by_payer": (
        lambda c, p: denial.denial_by_payer(c),
        f"SELECT payer, count(*), {_DENIED}, 100.0 * {_DENIED} / count(*) FROM claims GROUP BY 1",
    ),
    "status_distribution": (
        lambda c, p: denial.status_distribution(c),
        f"SELECT claim_status, count(*), {_SHARE}, sum(total_cost) FROM claims GROUP BY 1",
    ),
    "patient_summary": (
        lambda c, p: people.patient_summary(c, p).select(
            "patient_id", "total_claims", "total_cost", "avg_cost_per_claim", "total_oop",
            "readmissions", "last_service_date",
        ),
        """SELECT p.patient_id, count(claim_id), sum(total_cost), avg(total_cost), sum(patient_oop),
                  sum(readmission_30d), max(service_date)
           FROM patients p LEFT JOIN claims c ON p.patient_id = c.patient_id GROUP BY 1""",
    ),
    "cost_by_chronic": (
        lambda c, p: people.cost_by_chronic(c, p),
        "SELECT chronic_conditions, avg(total_cost) FROM claims JOIN patients USING (patient_id) GROUP BY 1",
    ),
    "quality_metrics": (
        lambda c, p: quality_mart.quality_metrics(c),
        f"""SELECT region, service_year, count(*), avg(total_cost), sum(total_cost),
                   coalesce(100.0 * avg(readmission_30d) FILTER (WHERE facility_type = 'Hospital'), 0),
                   100.0 * {_DENIED} / count(*),
                   coalesce(avg(length_of_stay) FILTER (WHERE facility_type = 'Hospital'), 0),
                   100.0 * sum(CASE WHEN facility_type = 'ER' THEN 1 ELSE 0 END) / count(*)
            FROM claims GROUP BY 1, 2""",
    ),
    "exec_kpis": (
        lambda c, p: measures.exec_kpis(c),
        f"""SELECT sum(total_cost), count(*), avg(total_cost),
                   100.0 * avg(readmission_30d) FILTER (WHERE facility_type = 'Hospital'),
                   100.0 * {_DENIED} / count(*) FROM claims""",
    ),
    "mart_claims_summary": (
        lambda c, p: marts.mart_claims_summary(c),
        f"""SELECT service_year, service_quarter, region, payer, facility_type, diagnosis_desc, count(*),
                   avg(total_cost), sum(total_cost), sum(paid_amount), sum(readmission_30d), {_RATE}
            FROM claims GROUP BY 1, 2, 3, 4, 5, 6""",
    ),
    "mart_payer_analysis": (
        lambda c, p: marts.mart_payer_analysis(c),
        f"""SELECT payer, service_year, count(*), avg(total_cost), avg(paid_amount),
                   100.0 * {_DENIED} / count(*) FROM claims GROUP BY 1, 2""",
    ),
}


def _order(row):
    """Sort by the leading non-float columns, which identify a row."""
    return tuple((value is None, str(value)) for value in row if not isinstance(value, float))


@pytest.mark.parametrize("name", CASES)
def test_agrees_with_plain_sql(data, name):
    claims_, patients_, connection = data
    operator, sql = CASES[name]
    plain = [
        tuple(float(v) if type(v).__name__ == "Decimal" else v for v in row)
        for row in connection.execute(sql).fetchall()
    ]
    found = [tuple(row) for row in operator(claims_, patients_).collect()]
    assert len(found) == len(plain) > 0
    keys = 6 if name == "mart_claims_summary" else 2
    for ours, theirs in zip(
        sorted(found, key=lambda r: _order(r[:keys])), sorted(plain, key=lambda r: _order(r[:keys]))
    ):
        for mine, other in zip(ours, theirs, strict=True):
            if isinstance(mine, float) and other is not None:
                assert mine == pytest.approx(float(other), abs=0.0101)
            else:
                assert mine == other
