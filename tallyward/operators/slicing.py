"""The report filters, applied before any report or mart query."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

# The columns a report can be filtered on.
SLICERS = ("service_year", "region", "payer", "facility_type")
# End of fixed values.


def slice_rows(
    frame: DataFrame, skip_missing: bool = False, **selected: Iterable | None
) -> DataFrame:
    """Keep rows whose value is among the selected ones, per slicer column.

    `None` selects everything.  The year slicer also answers to a column `year`, as
    the quality mart has it.  A slicer the frame has no column for is an error,
    unless `skip_missing` leaves it out.
    """
    unknown = set(selected) - set(SLICERS)
    if unknown:
        raise ValueError(f"not a slicer: {', '.join(sorted(unknown))}")
    for name, values in selected.items():
        if values is None:
            continue
        column = "year" if name == "service_year" and name not in frame.columns else name
        if column in frame.columns:
            frame = frame.filter(F.col(column).isin(list(values)))
        elif not skip_missing:
            raise ValueError(f"no column for the slicer {name}")
    return frame


@dataclass(frozen=True)
class Selection:
    """The values chosen on a report page; they reach every table of the page."""

    service_year: Iterable[int] | None = None
    region: Iterable[str] | None = None
    payer: Iterable[str] | None = None
    facility_type: Iterable[str] | None = None

    def chosen(self, without: Iterable[str] = ()) -> dict[str, Iterable]:
        """The slicers that have values, except those of `without`."""
        values = {name: getattr(self, name) for name in SLICERS if name not in without}
        return {name: each for name, each in values.items() if each is not None}

    def on(self, frame: DataFrame, without: Iterable[str] = ()) -> DataFrame:
        """Claims, a cube or a mart under the selection."""
        return slice_rows(frame, **self.chosen(without))

    def on_patients(self, patients: DataFrame, per_patient: DataFrame) -> DataFrame:
        """The patients of the selection.

        Slicers that patients have a column for choose among all of them, also those
        without claims.  The others choose through claims: patients stay that are in
        `per_patient`, the selected claims by patient.
        """
        own = {name: each for name, each in self.chosen().items() if name in patients.columns}
        kept = slice_rows(patients, **own)
        if set(self.chosen()) - set(own):
            kept = kept.join(per_patient.select("patient_id"), "patient_id", "left_semi")
        return kept
