"""Matrices: one row per row key, one column per value that is present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyward.session import materialize


def spread(
    grouped: DataFrame, row: str, column: str, value: str, values: Sequence | None = None,
    empty: object = None, rest: str | None = None,
) -> DataFrame:
    """`value` by `row` (rows) and `column` (columns); `grouped` has one row per cell.

    The columns are the values present, so no cell is lost; a NULL key is the column
    `null`, or `null_` if there is a value of that name.  `empty` stands where there is no
    cell or no value.  The grouped cells are written once and both passes read them.

    With a list of `values`, those are the columns, and a cell outside of the list is an
    error.  `rest` names a column with the number of the row's cells that are in none of
    the others: it is then 0 for a whole matrix, and a cell outside the list no error.
    """
    cells = materialize(grouped.select(F.col(row).alias("r"), F.col(column).alias("c"), F.col(value).alias("v")))
    if values is None or rest is None:
        found = [each[0] for each in cells.select("c").distinct().orderBy("c").collect()]
        other = [] if values is None else [each for each in found if each is None or each not in values]
        if other:
            raise ValueError(f"{column} is not among the listed values: {other[:5]}")
        values = found if values is None else values

    def in_column(key: object) -> Column:
        return F.col("c").isNull() if key is None else F.col("c") == F.lit(key)

    def name(key: object) -> str:
        return str(key) if key is not None else "null_" if "null" in values else "null"

    def cell(key: object) -> Column:
        found = F.max(F.when(in_column(key), F.col("v")))
        return (found if empty is None else F.coalesce(found, F.lit(empty))).alias(name(key))

    columns = [cell(key) for key in values]
    if rest is not None:
        shown = F.lit(False)
        for key in values:
            shown = shown | F.coalesce(in_column(key), F.lit(False))
        columns.append(F.count_if(~shown).alias(rest))
    rows = cells.groupBy(F.col("r").alias(row))
    return rows.agg(*columns) if columns else rows.count().select(row)
