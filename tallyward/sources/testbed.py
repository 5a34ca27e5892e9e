"""Patients and claims derived from a TPC-H-like set of parquet tables.

Every line item is one claim and every customer one patient.  The dimension
tables are left-joined on their primary keys, so a join can neither drop nor
multiply claims, and one that adds no requested column is left out.  Customers
are attached to orders first: where the tables are too large to broadcast, the
wide line-item table is then shuffled once instead of once per dimension.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyward.functions.lookup import lookup, nth_of
from tallyward.operators.enrich import apply_rate_card, enrich_calendar, enrich_codes
from tallyward.schemas import CLAIMS, DIAGNOSES, HOSPITAL, MONEY, PATIENTS, PROCEDURES, REGIONS
from tallyward.session import broadcast_if_small

# How source categories map to the claims model.
SEGMENT_PAYERS = {
    "AUTOMOBILE": "Medicare",
    "BUILDING": "Medicaid",
    "FURNITURE": "BlueCross",
    "HOUSEHOLD": "Aetna",
    "MACHINERY": "UnitedHealth",
}
PART_FACILITIES = {
    "LARGE": "Hospital",
    "STANDARD": "Hospital",
    "PROMO": "ER",
    "MEDIUM": "Outpatient Clinic",
    "SMALL": "Specialist Office",
    "ECONOMY": "Primary Care",
}
FLAG_STATUS = {"R": "Denied", "N": "Pending", "A": "Approved"}
# End of fixed values.


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{table}.parquet")


def _gender() -> Column:
    third = F.floor(F.col("c_custkey") / 6).cast("bigint") % 3
    return F.when(third == 0, "M").when(third == 1, "F").otherwise("Other")


def _payer() -> Column:
    segment = lookup(F.col("c_mktsegment"), SEGMENT_PAYERS)
    return F.when(F.col("c_acctbal") < 0, "Self-Pay").otherwise(segment)


_PATIENT_COLUMNS = {
    "patient_id": lambda: F.col("c_custkey"),
    "age": lambda: (18 + (F.col("c_custkey") * 37) % 78).cast("int"),
    "gender": _gender,
    "region": lambda: nth_of(F.col("n_regionkey"), REGIONS),
    "payer": _payer,
    "zip_code": lambda: (10000 + F.col("c_custkey") % 90000).cast("string"),
    "chronic_conditions": lambda: (F.col("c_custkey") % 6).cast("int"),
    "enrollment_date": lambda: F.date_add(
        F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")
    ),
}


_CLAIM_COLUMNS = {
    "claim_id": lambda: F.col("l_orderkey") * 8 + F.col("l_linenumber"),
    "service_date": lambda: F.col("l_shipdate").cast("date"),
    "diagnosis_code": lambda: nth_of(F.col("l_partkey") % 10, list(DIAGNOSES)),
    "procedure_code": lambda: nth_of(F.col("l_suppkey") % 10, list(PROCEDURES)),
    "total_cost": lambda: F.col("l_extendedprice").cast(MONEY),
    "length_of_stay": lambda: F.when(
        F.col("facility_type") == HOSPITAL, F.col("l_quantity").cast("int") % 15
    ).otherwise(0),
    "readmission_30d": lambda: F.when(
        (F.col("facility_type") == HOSPITAL) & (F.col("l_linenumber") == 7), 1
    ).otherwise(0),
    "claim_status": lambda: lookup(F.col("l_returnflag"), FLAG_STATUS),
}
_CALENDAR = {"service_year", "service_month", "service_quarter"}
_DESCRIPTIONS = {"diagnosis_desc", "procedure_desc"}
_PAYMENT = {"paid_amount", "patient_oop"}
_FROM_PART = {"facility_type", "length_of_stay", "readmission_30d"}
_FROM_PATIENT = {"region", "payer", *_PAYMENT}


def patients(
    spark: SparkSession, path: str, columns: Iterable[str] = tuple(PATIENTS.names)
) -> DataFrame:
    """The requested patient columns, one row per customer."""
    columns = list(columns)
    people = _read(spark, path, "customer")
    if "region" in columns:
        nations = _read(spark, path, "nation").select("n_nationkey", "n_regionkey")
        people = people.join(nations, people.c_nationkey == nations.n_nationkey, "left")
    return people.select(*[_PATIENT_COLUMNS[name]().alias(name) for name in columns])


def _holders(spark: SparkSession, path: str, traits: list[str]) -> DataFrame:
    """The patient behind each order, with the requested traits."""
    orders = _read(spark, path, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("patient_id")
    )
    if not traits:
        return orders
    customers = _read(spark, path, "customer")
    people = broadcast_if_small(patients(spark, path, ["patient_id", *traits]), customers)
    return broadcast_if_small(orders.join(people, "patient_id", "left"), orders, customers)


def claims(
    spark: SparkSession, path: str, columns: Iterable[str] = tuple(CLAIMS.names)
) -> DataFrame:
    """The requested claim columns, one row per line item."""
    columns = list(columns)
    wanted = set(columns)
    lines = _read(spark, path, "lineitem")

    if wanted & _FROM_PART:
        parts = _read(spark, path, "part").select(
            "p_partkey", lookup(F.col("p_type"), PART_FACILITIES).alias("facility_type")
        )
        lines = lines.join(parts, lines.l_partkey == parts.p_partkey, "left")
    if wanted & {"patient_id", *_FROM_PATIENT}:
        traits = ["region"] if "region" in wanted else []
        traits += ["payer"] if wanted & {"payer", *_PAYMENT} else []
        holders = _holders(spark, path, traits)
        lines = lines.join(holders, lines.l_orderkey == holders.o_orderkey, "left")

    base = set(wanted)
    base |= {"service_date"} if wanted & _CALENDAR else set()
    base |= {"diagnosis_code", "procedure_code"} if wanted & _DESCRIPTIONS else set()
    base |= {"total_cost"} if wanted & _PAYMENT else set()
    lines = lines.withColumns(
        {name: column() for name, column in _CLAIM_COLUMNS.items() if name in base}
    )
    if wanted & _CALENDAR:
        lines = enrich_calendar(lines)
    if wanted & _DESCRIPTIONS:
        lines = enrich_codes(lines)
    if wanted & _PAYMENT:
        lines = apply_rate_card(lines)
    return lines.select(*columns)
