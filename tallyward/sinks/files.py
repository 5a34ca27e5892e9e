"""Writing reports, datasets and marts."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tallyward.operators.slicing import Selection
from tallyward.plans.dashboard import CONTEXT, PANEL_BLOCKS, PANEL_KEYS, dashboard
from tallyward.plans.marts import all_marts, claims_cube, patient_cube
from tallyward.session import materialize


_PARALLEL_WRITES = 4


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def write_qc_report(report: DataFrame, path: str) -> None:
    """Write the ten-row report as CSV."""
    write_csv(report, path)


def write_datasets(tables: Mapping[str, DataFrame], root: str) -> None:
    """Write every table as CSV with a header below `root`."""
    write_all(tables, root, csv=True)


def store_claims(claims: DataFrame, path: str) -> None:
    """Replace the stored claims table, laid out for the year slicer.

    The rebalance hint gathers a year's rows before they are written, so a task
    opens few files, and lets adaptive execution split a year that is too large.
    """
    claims.hint("rebalance", "service_year").write.mode("overwrite").partitionBy(
        "service_year"
    ).parquet(path)


def write_all(frames: Mapping[str, DataFrame], root: str, csv: bool = False) -> None:
    """Replace one parquet (or CSV) table per frame below `root`.

    The writes do not depend on each other, and most are far too small to fill a
    cluster, so a few of them run at a time.
    """

    def write(item: tuple[str, DataFrame]) -> None:
        name, frame = item
        if csv:
            write_csv(frame, f"{root}/{name}")
        else:
            frame.write.mode("overwrite").parquet(f"{root}/{name}")

    session = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(_PARALLEL_WRITES) as pool:
        list(pool.map(inheritable_thread_target(session)(write), frames.items()))


Cubes = tuple[DataFrame, DataFrame]


def build_cubes(claims: DataFrame, selection: Selection | None = None) -> Cubes:
    """The category and the patient cube behind all marts and panels: two scans.

    The patient cube is of the selected claims.  The category cube has the slicers that
    measures look beyond among its keys; the others reach the scan.
    """
    selection = selection or Selection()
    cube = claims_cube(selection.on(claims, CONTEXT), PANEL_KEYS, PANEL_BLOCKS)
    return materialize(cube), materialize(patient_cube(selection.on(claims)))


def export_marts(
    claims: DataFrame,
    patients: DataFrame,
    root: str,
    csv: bool = False,
    cubes: Cubes | None = None,
    metrics: DataFrame | None = None,
    selection: Selection | None = None,
) -> list[str]:
    """Write all six marts below `root` and return their names.

    `cubes` are those of `build_cubes` for the same selection, if they are there already;
    `metrics` is a quality table of the selection.
    """
    selection = selection or Selection()
    if cubes is None:
        claims = selection.on(claims)
        cubes = materialize(claims_cube(claims)), patient_cube(claims)
    cube, per_patient = cubes
    marts = all_marts(selection.on(cube), per_patient, selection.on_patients(patients, per_patient), metrics)
    write_all(marts, root, csv)
    return list(marts)


def export_dashboard(
    claims: DataFrame,
    patients: DataFrame,
    root: str,
    csv: bool = False,
    cubes: Cubes | None = None,
    metrics: DataFrame | None = None,
    selection: Selection | None = None,
) -> list[str]:
    """Write the data of all dashboard panels below `root` and return their names."""
    panels = dashboard(*(cubes or build_cubes(claims, selection)), patients, metrics, selection)
    write_all(panels, root, csv)
    return list(panels)
