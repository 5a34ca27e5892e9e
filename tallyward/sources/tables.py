"""Reading the claims tables with declared schemas and exposing them to SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from csv import reader
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyward.functions.lookup import quoted
from tallyward.schemas import SUMMARY_TYPES, TABLES


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below `path` that have lines, by the column names of their first line.

    All lines are scanned as text, none is parsed; what comes back is one line a file.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
    )
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():
        names = tuple(name.strip() for name in next(reader([row["header"].lstrip("\ufeff")])))
        found.setdefault(names, []).append(unquote(row["file"]))
    return found


def _read_csv(spark: SparkSession, files: str | list[str], header: Sequence[str], schema: T.StructType) -> DataFrame:
    """The declared columns of CSV files whose header is `header`, in that order."""
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{files if isinstance(files, str) else files[0]} has no column {', '.join(missing)}")
    declared = {field.name: field for field in schema.fields}
    own = T.StructType([declared.get(name, T.StructField(name, T.StringType())) for name in header])
    # Each file's header is compared with `own` when the file is read.
    options = {"header": True, "enforceSchema": False, "mode": "FAILFAST"}
    return spark.read.schema(own).options(**options).csv(files).select(*map(quoted, schema.names))


def read_table(
    spark: SparkSession, path: str, name: str, fmt: str = "csv", strict: bool = False, one_header: bool = False
) -> DataFrame:
    """One table with its declared types.

    CSV columns are found by the names in the header of each file, in any order; further ones
    are left out and a missing one is an error.  That takes a scan of the lines; with
    `one_header` the first file's header holds for all, and a file with another fails the read.
    A row with a value that does not parse fails the read if the column is used, with
    `strict` in any case.
    """
    schema = TABLES[name]
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    plain = spark.read.option("header", True).csv(path)
    groups = {tuple(plain.columns): path} if one_header or len(plain.inputFiles()) < 2 else _headers(spark, path)
    parts = [_read_csv(spark, files, header, schema) for header, files in (groups or {(): path}).items()]
    table = reduce(DataFrame.unionByName, parts)
    if strict:  # always true, but it makes every query parse all columns
        every = F.concat_ws("", *[F.col(column).cast("string") for column in schema.names])
        table = table.filter(F.length(every) >= 0)
    return table


def read_tables(
    spark: SparkSession, root: str, fmt: str = "csv", suffix: str = ""
) -> dict[str, DataFrame]:
    """All three tables below `root`, stored as `<name><suffix>` files or folders."""
    return {name: read_table(spark, f"{root}/{name}{suffix}", name, fmt) for name in TABLES}


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    """Create or replace one temp view per table."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def coerce_schema(
    frame: DataFrame, types: Mapping[str, str] = SUMMARY_TYPES, lenient: bool = False
) -> DataFrame:
    """Cast the named columns of a table that was read as text.

    A value that does not parse is an error, or NULL when `lenient`.
    """

    def convert(name: str):
        if name not in types:
            return F.col(name)
        column = F.col(name)
        cast = column.try_cast(types[name]) if lenient else column.cast(types[name])
        return cast.alias(name)

    return frame.select(*[convert(name) for name in frame.columns])
