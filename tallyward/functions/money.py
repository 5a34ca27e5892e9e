"""Exact money arithmetic.

Money is summed as integer cents, divided once in double precision and rounded
at scale 0 before the decimal point is put back.  Results therefore do not
depend on the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(amount: str | Column) -> Column:
    """Integer cents of an amount with at most two decimals."""
    return F.rint(_column(amount).cast("double") * 100).cast("bigint")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division that yields NULL on a zero denominator."""
    return _column(numerator).cast("double") / F.nullif(_column(denominator), F.lit(0))


def quotient(value: Column, divisor: Column) -> Column:
    """Integer division, exact where a rounded double quotient might not be."""
    return F.call_function("div", value, divisor)


def from_cents(total: str | Column) -> Column:
    return _column(total).cast("double") / 100


def mean_money(total: str | Column, rows: str | Column) -> Column:
    """Mean amount to the cent, half away from zero."""
    return F.round(ratio(total, rows), 0) / 100


def exact_mean_money(total: str | Column, rows: str | Column) -> Column:
    """Mean amount without rounding."""
    return ratio(total, _column(rows) * 100)


def percent(part: str | Column, whole: str | Column, places: int = 2) -> Column:
    """`part` as a percentage of `whole`, half away from zero."""
    scaled = F.lit(float(10 ** (places + 2))) * _column(part).cast("double")
    return F.round(ratio(scaled, whole), 0) / 10**places


def percent_half_even(part: str | Column, whole: str | Column) -> Column:
    """Like :func:`percent` at two places, but ties go to the even digit."""
    return F.rint(ratio(F.lit(10000.0) * _column(part).cast("double"), whole)) / 100


def mean_half_even(total: str | Column, rows: str | Column, scale: int = 1) -> Column:
    """`total / rows` in units of 1/`scale`, at two places with half-even ties."""
    return F.rint(ratio(F.lit(100.0 / scale) * _column(total).cast("double"), rows)) / 100


def coverage(
    paid: str | Column,
    paid_rows: str | Column,
    billed: str | Column,
    billed_rows: str | Column,
) -> Column:
    """Mean paid as a percentage of mean billed, one decimal.

    The row-count factor is exactly 1 unless NULLs make the two means cover
    different rows.
    """
    share = ratio(F.lit(1000.0) * _column(paid).cast("double"), billed)
    return F.round(share * ratio(billed_rows, paid_rows), 0) / 10
