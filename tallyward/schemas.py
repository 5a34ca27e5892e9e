"""Declared schemas and the fixed values of the claims model."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PATIENTS = _struct(
    patient_id=T.LongType(),
    age=T.IntegerType(),
    gender=T.StringType(),
    region=T.StringType(),
    payer=T.StringType(),
    zip_code=T.StringType(),
    chronic_conditions=T.IntegerType(),
    enrollment_date=T.DateType(),
)

CLAIMS = _struct(
    claim_id=T.LongType(),
    patient_id=T.LongType(),
    service_date=T.DateType(),
    service_year=T.IntegerType(),
    service_month=T.IntegerType(),
    service_quarter=T.StringType(),
    diagnosis_code=T.StringType(),
    diagnosis_desc=T.StringType(),
    procedure_code=T.StringType(),
    procedure_desc=T.StringType(),
    facility_type=T.StringType(),
    region=T.StringType(),
    payer=T.StringType(),
    total_cost=MONEY,
    paid_amount=MONEY,
    patient_oop=MONEY,
    length_of_stay=T.IntegerType(),
    readmission_30d=T.IntegerType(),
    claim_status=T.StringType(),
)

QUALITY_METRICS = _struct(
    region=T.StringType(),
    year=T.IntegerType(),
    total_claims=T.LongType(),
    avg_cost_per_claim=T.DoubleType(),
    total_spend=T.DoubleType(),
    readmission_rate_pct=T.DoubleType(),
    denial_rate_pct=T.DoubleType(),
    avg_los_hospital=T.DoubleType(),
    er_visit_rate_pct=T.DoubleType(),
)

TABLES = {"patients": PATIENTS, "claims": CLAIMS, "quality_metrics": QUALITY_METRICS}

# Types a claims-summary mart gets back after a trip through a text format.
SUMMARY_TYPES = {
    "service_year": "bigint",
    "total_spend": "double",
    "avg_cost": "double",
    "claims": "bigint",
    "readmissions": "bigint",
    "readmit_pct": "double",
}

# The domains and lookup tables of the claims model.
REGIONS = ["Northeast", "Southeast", "Midwest", "West", "Southwest"]
FACILITY_TYPES = ["Hospital", "Outpatient Clinic", "ER", "Specialist Office", "Primary Care"]
QUARTERS = ["Q1", "Q2", "Q3", "Q4"]
DIAGNOSES = {
    "E11": "Type 2 Diabetes",
    "I10": "Hypertension",
    "J45": "Asthma",
    "M54": "Back Pain",
    "F32": "Depression",
    "I25": "Coronary Artery Disease",
    "N18": "Chronic Kidney Disease",
    "J44": "COPD",
    "Z51": "Chemotherapy",
    "S72": "Hip Fracture",
}
PROCEDURES = {
    "99213": "Office Visit",
    "93000": "EKG",
    "71046": "Chest X-Ray",
    "80053": "Comprehensive Metabolic Panel",
    "85025": "Complete Blood Count",
    "99232": "Subsequent Hospital Care",
    "27447": "Knee Replacement",
    "43239": "Upper GI Endoscopy",
    "99285": "Emergency Dept Visit",
    "36415": "Blood Draw",
}
PAID_SHARE = {
    "Medicare": Decimal("0.80"),
    "Medicaid": Decimal("0.65"),
    "BlueCross": Decimal("0.78"),
    "Aetna": Decimal("0.75"),
    "UnitedHealth": Decimal("0.77"),
    "Self-Pay": Decimal("0.45"),
}
AGE_BANDS = [
    (18, 30, "18-29"),
    (30, 40, "30-39"),
    (40, 50, "40-49"),
    (50, 60, "50-59"),
    (60, 70, "60-69"),
    (70, 80, "70-79"),
    (80, 95, "80+"),
]
HOSPITAL = "Hospital"
EMERGENCY = "ER"
DENIED = "Denied"
LONG_STAY_DAYS = 30
# End of fixed values.
