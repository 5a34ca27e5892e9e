"""Additive building blocks that all reports are computed from.

Each block can be merged by a plain sum (or min/max), so every report that groups
claims can start from raw claims or from an already grouped frame, and rounding
happens only when a report is presented.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyward.functions.money import cents
from tallyward.schemas import DENIED, EMERGENCY, HOSPITAL


def _in_hospital(column: str) -> Column:
    return F.when(F.col("facility_type") == HOSPITAL, F.col(column))


BLOCKS = {
    "claims": lambda: F.count(F.lit(1)),
    "claim_ids": lambda: F.count("claim_id"),
    "cost_cents": lambda: F.sum(cents("total_cost")),
    "cost_rows": lambda: F.count("total_cost"),
    "paid_cents": lambda: F.sum(cents("paid_amount")),
    "paid_rows": lambda: F.count("paid_amount"),
    "oop_cents": lambda: F.sum(cents("patient_oop")),
    "oop_rows": lambda: F.count("patient_oop"),
    "readmissions": lambda: F.sum(F.col("readmission_30d").cast("bigint")),
    "denied": lambda: F.count_if(F.col("claim_status") == DENIED),
    "er_claims": lambda: F.count_if(F.col("facility_type") == EMERGENCY),
    "hospital_readmissions": lambda: F.sum(_in_hospital("readmission_30d").cast("bigint")),
    "hospital_flags": lambda: F.count(_in_hospital("readmission_30d")),
    "hospital_days": lambda: F.sum(_in_hospital("length_of_stay").cast("bigint")),
    "hospital_stays": lambda: F.count(_in_hospital("length_of_stay")),
    "min_cents": lambda: F.min(cents("total_cost")),
    "max_cents": lambda: F.max(cents("total_cost")),
    "last_service_date": lambda: F.max("service_date"),
}
_MERGE = {"min_cents": F.min, "max_cents": F.max, "last_service_date": F.max}

COST = ["claims", "cost_cents", "cost_rows"]


#: Key of the column metadata that says which block a column holds.
_MARK = "tallyward.block"


def held_blocks(frame: DataFrame) -> dict[str, str]:
    """The blocks that `frame` holds, and the column of each; none for raw claims."""
    marks = {field.metadata.get(_MARK): field.name for field in frame.schema.fields}
    return {block: column for block, column in marks.items() if block in BLOCKS}


def rollup(frame: DataFrame, by: Sequence[str], blocks: Sequence[str]) -> DataFrame:
    """Group by `by` and compute the named blocks.

    `frame` holds raw claims, or an earlier roll-up that kept the columns of `by`
    and these blocks; the latter is merged instead of recomputed.  Blocks are marked in
    the metadata of their columns, which Spark keeps through projections, joins and
    Parquet files, so raw claims may have columns of any name.  A frame with some
    blocks but not all of these is neither, and an error.
    """
    held = held_blocks(frame)
    if held and not set(blocks) <= set(held):
        raise ValueError(f"the cube lacks {', '.join(sorted(set(blocks) - set(held)))}")
    measures = [
        (_MERGE.get(name, F.sum)(held[name]) if held else BLOCKS[name]()).alias(name, metadata={_MARK: name})
        for name in blocks
    ]
    return frame.groupBy(*by).agg(*measures)
