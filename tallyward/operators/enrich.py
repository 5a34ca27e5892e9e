"""Per-row preparation of claims, and the calendar table."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tallyward.functions.lookup import lookup, nth_of
from tallyward.schemas import DIAGNOSES, MONEY, PAID_SHARE, PROCEDURES, QUARTERS
from tallyward.session import broadcast_if_small


def quarter_label(date: str | Column) -> Column:
    return nth_of(F.quarter(date) - 1, QUARTERS)


def enrich_calendar(claims: DataFrame, date: str = "service_date") -> DataFrame:
    """Add year, month and quarter of service."""
    return claims.withColumns(
        {
            "service_year": F.year(date),
            "service_month": F.month(date),
            "service_quarter": quarter_label(date),
        }
    )


def enrich_codes(
    claims: DataFrame,
    diagnoses: Mapping[str, str] = DIAGNOSES,
    procedures: Mapping[str, str] = PROCEDURES,
) -> DataFrame:
    """Add descriptions for diagnosis and procedure codes, NULL where unknown."""
    return claims.withColumns(
        {
            "diagnosis_desc": lookup(F.col("diagnosis_code"), diagnoses),
            "procedure_desc": lookup(F.col("procedure_code"), procedures),
        }
    )


def with_dimension(claims: DataFrame, dimension: DataFrame, key: str, *columns: str) -> DataFrame:
    """Add `columns` of `dimension` by `key`, NULL where it has no such key.

    A key that the dimension has more than once fails the query, so that every claim stays one
    row.  A small dimension is broadcast; beyond that adaptive execution splits hot keys.
    """
    double = F.concat(F.lit(f"the dimension has more than one row for {key} "), F.col(key).cast("string"))
    single = dimension.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[
            F.when(F.count(F.lit(1)) > 1, F.raise_error(double)).otherwise(F.first(column)).alias(column)
            for column in columns
        ]
    )
    plain = claims.drop(*columns)
    order = [*claims.columns, *(column for column in columns if column not in claims.columns)]
    return plain.join(broadcast_if_small(single, dimension), key, "left").select(*order)


def enrich_codes_from(claims: DataFrame, diagnoses: DataFrame, procedures: DataFrame) -> DataFrame:
    """`enrich_codes` with tables (diagnosis_code, diagnosis_desc) and (procedure_code, procedure_desc)."""
    named = with_dimension(claims, diagnoses, "diagnosis_code", "diagnosis_desc")
    return with_dimension(named, procedures, "procedure_code", "procedure_desc")


def apply_rates_from(claims: DataFrame, rates: DataFrame) -> DataFrame:
    """`apply_rate_card` with a table (payer, rate); rates are parts of one."""
    share = F.col("_rate").cast("decimal(3,2)")
    rated = with_dimension(claims, rates.select("payer", F.col("rate").alias("_rate")), "payer", "_rate")
    return _split_cost(rated, share).drop("_rate")


def _split_cost(claims: DataFrame, share: Column) -> DataFrame:
    paid = F.round(F.col("total_cost") * share, 2).cast(MONEY)
    return claims.withColumn("paid_amount", paid).withColumn(
        "patient_oop", (F.col("total_cost") - F.col("paid_amount")).cast(MONEY)
    )


def apply_rate_card(
    claims: DataFrame, shares: Mapping[str, Decimal] = PAID_SHARE
) -> DataFrame:
    """Split `total_cost` into the payer's share and the patient's remainder."""
    return _split_cost(claims, lookup(F.col("payer"), shares, "decimal(3,2)"))


def date_table(days: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per calendar day for each `start`..`end` range in `days`."""
    every_day = F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day")))
    day = F.col("Date")
    return days.select(every_day.alias("Date")).select(
        day,
        F.year(day).alias("Year"),
        quarter_label(day).alias("Quarter"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMM").alias("MonthName"),
        F.date_format(day, "yyyy-MM").alias("YearMonth"),
    )


def service_range(claims: DataFrame) -> DataFrame:
    """First and last service date as one `start`, `end` row."""
    return claims.agg(F.min("service_date").alias("start"), F.max("service_date").alias("end"))
