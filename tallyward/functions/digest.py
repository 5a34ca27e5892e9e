"""Order-free digests of tables, in terms that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyward.functions.lookup import quoted

# The form of a row as text, see `row_text`.
NULL, SEPARATOR = "~", "|"
PRIME = 1_000_000_007
# End of fixed values.


def _text(name: str, kind: str) -> Column:
    value = F.col(quoted(name))
    if kind in ("double", "float"):
        value = F.round(value * 10_000, 0).cast("bigint")
    elif kind.startswith("decimal"):
        value = (value * 100).cast("bigint")
    return F.coalesce(value.cast("string"), F.lit(NULL))


def row_text(frame: DataFrame) -> Column:
    """A row as text: columns by name, floating numbers in ten-thousandths, money in cents."""
    return F.concat_ws(SEPARATOR, *[_text(name, kind) for name, kind in sorted(frame.dtypes)])


def table_digest(frame: DataFrame) -> DataFrame:
    """One row: how many rows, and the exclusive or and the sum of their hashes.

    Neither depends on the order of rows; the sum also tells rows that occur twice from
    rows that are not there.  Everything is added up where the rows lie.
    """
    number = F.conv(F.substring(F.md5(row_text(frame).cast("binary")), 1, 15), 16, 10).cast("bigint")
    hashed = frame.select(number.alias("hash"))
    return hashed.agg(
        F.count("hash").alias("rows"),
        F.coalesce(F.bit_xor("hash"), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(F.col("hash") % PRIME), F.lit(0)).alias("hash_sum"),
    )
