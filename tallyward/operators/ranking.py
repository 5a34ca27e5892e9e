"""A global rank and NTILE that never bring all rows to one task.

Rows are range-partitioned and sorted, numbered inside their partition, and
shifted by the number of rows in the partitions before.  Range bounds come from a
sample and could differ between two evaluations, so the numbered rows are written
to the shared folder once and everything later reads those files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyward.functions.additive import rollup
from tallyward.functions.money import from_cents, percent, quotient
from tallyward.session import materialize

# Fixed value: the label of the cohort row.
COHORT = "Top 5% high-cost patients"
# End of fixed values.

# monotonically_increasing_id puts the partition above the low 33 bits.
_ROW_BITS = 33


def global_rank(frame: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position in `order`, and the row count as `<name>_of`.

    `order` has to be total, i.e. end in a unique column.
    """
    numbered = materialize(
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    part = F.shiftright("_position", _ROW_BITS)
    within = F.col("_position") - F.shiftleft(part, _ROW_BITS)

    # One row per non-empty partition, so both windows and the broadcast are
    # bounded by the number of shuffle partitions whatever the data size.
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias(f"{name}_of"),
    )
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within + 1)
        .drop("_part", "_position", "_before")
    )


def ntile_of(rank: str, total: str, tiles: int) -> Column:
    """SQL's NTILE computed from a 1-based rank and the row count.

    The first `total mod tiles` tiles hold one row more than the others.
    """
    rank_, total_ = F.col(rank), F.col(total)
    size = quotient(total_, F.lit(tiles))
    larger = total_ % tiles
    in_larger = larger * (size + 1)
    early = quotient(rank_ - 1, size + 1)
    late = larger + quotient(rank_ - 1 - in_larger, F.nullif(size, F.lit(0)))
    return (F.when(rank_ <= in_larger, early).otherwise(late) + 1).cast("int")


def _tiled_patients(claims: DataFrame, tiles: int) -> DataFrame:
    totals = rollup(claims, ["patient_id"], ["cost_cents"])
    ranked = global_rank(totals, [F.desc_nulls_last("cost_cents"), F.asc("patient_id")])
    return ranked.withColumn("tile", ntile_of("rank", "rank_of", tiles))


def patient_ntile(claims: DataFrame, tiles: int = 20) -> DataFrame:
    """Patients by summed cost, most expensive first, split into equal tiles.

    Patients of equal cost are ordered by id.
    """
    return _tiled_patients(claims, tiles).select(
        "patient_id", from_cents("cost_cents").alias("total_patient_cost"), "tile"
    )


def high_cost_cohort(claims: DataFrame, tiles: int = 20, label: str = COHORT) -> DataFrame:
    """Size, spend and share of all spend of the most expensive tile."""
    tiled = _tiled_patients(claims, tiles)
    # Every claim belongs to exactly one patient total, so the total over all
    # tiles is the total over all claims and no second scan is needed.
    top = F.col("tile") == 1
    return tiled.agg(
        F.count_if(top).alias("patient_count"),
        F.sum(F.when(top, F.col("cost_cents"))).alias("cohort_cents"),
        F.sum("cost_cents").alias("all_cents"),
    ).select(
        F.lit(label).alias("cohort"),
        "patient_count",
        from_cents("cohort_cents").alias("cohort_spend"),
        percent("cohort_cents", "all_cents").alias("pct_of_total_spend"),
    )
