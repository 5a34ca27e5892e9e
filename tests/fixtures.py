"""Small hand-made tables for the edge cases the big test tables do not have."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from tallyward.schemas import CLAIMS, PATIENTS

PATIENT = {
    "age": 50,
    "gender": "F",
    "region": "West",
    "payer": "Aetna",
    "zip_code": "01234",
    "chronic_conditions": 1,
    "enrollment_date": date(2020, 1, 1),
}
CLAIM = {
    "patient_id": 1,
    "service_date": date(2023, 5, 17),
    "service_year": 2023,
    "service_month": 5,
    "service_quarter": "Q2",
    "diagnosis_code": "I10",
    "diagnosis_desc": "Hypertension",
    "procedure_code": "93000",
    "procedure_desc": "EKG",
    "facility_type": "Hospital",
    "region": "West",
    "payer": "Aetna",
    "total_cost": "100.00",
    "paid_amount": "75.00",
    "patient_oop": "25.00",
    "length_of_stay": 2,
    "readmission_30d": 0,
    "claim_status": "Approved",
}
_MONEY = ("total_cost", "paid_amount", "patient_oop")


def claims(spark, *changes):
    """One claim per set of changes to the standard claim."""
    rows = []
    for number, change in enumerate(changes, start=1):
        row = {"claim_id": number, **CLAIM, **change}
        for name in _MONEY:
            row[name] = None if row[name] is None else Decimal(row[name])
        rows.append(tuple(row[name] for name in CLAIMS.names))
    return spark.createDataFrame(rows, CLAIMS)


def patients(spark, *changes):
    rows = []
    for number, change in enumerate(changes, start=1):
        row = {"patient_id": number, **PATIENT, **change}
        rows.append(tuple(row[name] for name in PATIENTS.names))
    return spark.createDataFrame(rows, PATIENTS)


def rows(frame):
    return [tuple(row) for row in frame.collect()]
