"""Run the whole workload over a folder of tables.

    python -m tallyward validate DATA OUTPUT [--as-of DATE]
    python -m tallyward analyze  DATA OUTPUT [--csv]

Both take the report filters: --service-year, --region, --payer, --facility-type.

DATA holds `patients`, `claims` and, optionally, `quality_metrics` as CSV with a header (or
as parquet with --parquet).  A quality table that is there is used as it is, if its regions
and years are those of the claims; filters that it has no column for make it be computed.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyward.operators.quality import qc_report, qc_total_flags
from tallyward.operators.slicing import SLICERS, Selection
from tallyward.plans.quality_metrics import matching
from tallyward.sinks import files
from tallyward.sources.tables import read_table


def stored_metrics(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """The quality table at `path`, if there is one."""
    try:
        return read_table(spark, path, "quality_metrics", kind)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyward")
    parser.add_argument("job", choices=["validate", "analyze"])
    parser.add_argument("data")
    parser.add_argument("output")
    parser.add_argument("--parquet", action="store_true", help="DATA is parquet, not CSV")
    parser.add_argument("--csv", action="store_true", help="write CSV instead of parquet")
    parser.add_argument("--as-of", type=date.fromisoformat, help="the day that counts as today")
    for name in SLICERS:
        kind = int if name == "service_year" else str
        parser.add_argument(f"--{name.replace('_', '-')}", nargs="+", type=kind, help="keep only these")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tallyward").getOrCreate()
    kind = "parquet" if options.parquet else "csv"
    claims, patients = (
        read_table(spark, f"{options.data}/{name}", name, kind, strict=options.job == "validate")
        for name in ("claims", "patients")
    )
    selection = Selection(**{name: getattr(options, name) for name in SLICERS})
    if options.job == "validate":
        target = f"{options.output}/data_validation_report"
        files.write_qc_report(qc_report(selection.on(claims), patients, options.as_of), target)
        schema = "check string, flagged_records bigint, status string"
        written = spark.read.schema(schema).option("header", True).csv(target)
        written.orderBy("check").show(truncate=False)
        print(f"Total flagged records: {qc_total_flags(written).first().total_flagged:,}")
    else:
        cubes = files.build_cubes(claims, selection)
        metrics = None
        if not {"payer", "facility_type"} & set(selection.chosen()):
            metrics = stored_metrics(spark, f"{options.data}/quality_metrics", kind)
        if metrics is not None:
            metrics = matching(selection.on(metrics), selection.on(cubes[0]))
        for export, folder in ((files.export_dashboard, "panels"), (files.export_marts, "marts")):
            export(claims, patients, f"{options.output}/{folder}", options.csv, cubes, metrics, selection)


if __name__ == "__main__":
    main()
