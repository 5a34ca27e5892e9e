"""Exact interpolated percentiles without collecting a group in one place.

Claims are read once, to count the rows of every distinct amount per group; the counts
are kept.  From them come the buckets of 2^16 cents, the few buckets a group's
percentiles fall in, and in those the amounts at the wanted positions.  No step sorts
more than the buckets of a group or the 2^16 distinct amounts of a bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyward.functions.money import cents, mean_money, quotient
from tallyward.session import materialize

_BUCKET_BITS = 16

# The percentiles of the regional report.
REPORT_POINTS = {"p25": "0.25", "median": "0.50", "p75": "0.75", "p90": "0.90"}
# End of fixed values.


def _positions(point: Fraction) -> tuple[Column, Column]:
    """0-based positions of the two amounts a percentile lies between."""
    scaled = (F.col("_rows") - 1) * point.numerator
    below = quotient(scaled, F.lit(point.denominator))
    above = F.when(scaled % point.denominator == 0, below).otherwise(below + 1)
    return below, above


def _interpolated(name: str, point: Fraction) -> Column:
    part = ((F.col("_rows") - 1) * point.numerator) % point.denominator
    low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
    exact = low * (point.denominator - part) + high * part
    return (F.round(exact.cast("double") / point.denominator, 0) / 100).alias(name)


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be NULL, keeping the left ones."""
    other = right.select(*[F.col(c).alias(f"{c}_r") if c in keys else c for c in right.columns])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key}_r"))
    return left.join(other, same, how).drop(*[f"{key}_r" for key in keys])


def grouped_percentiles(
    claims: DataFrame,
    by: Sequence[str],
    amount: str = "total_cost",
    points: Mapping[str, str] = REPORT_POINTS,
) -> DataFrame:
    """Linear-interpolation percentiles and the mean of `amount` per group.

    `points` maps output names to decimal fractions.  NULL amounts are ignored; a
    group that has nothing else gets NULLs.
    """
    if not by:
        raise ValueError("name at least one column to group by")
    fractions = {name: Fraction(point) for name, point in points.items()}
    wanted = {
        f"_{name}_{side}": position
        for name, point in fractions.items()
        for side, position in zip(("low", "high"), _positions(point))
    }
    keys = [f"_key{i}" for i in range(len(by))]
    amounts = claims.select(
        *[F.col(column).alias(key) for column, key in zip(by, keys)], cents(amount).alias("_cents")
    ).withColumn("_bucket", F.shiftright("_cents", _BUCKET_BITS))

    counted = materialize(
        amounts.groupBy(*keys, "_bucket", "_cents").agg(F.count("_cents").alias("_count"))
    )

    group = Window.partitionBy(*keys)
    up_to = (Window.unboundedPreceding, Window.currentRow)
    buckets = (
        counted.groupBy(*keys, "_bucket")
        .agg(F.sum("_count").alias("_n"), F.sum(F.col("_cents") * F.col("_count")).alias("_sum"))
        .withColumns(
            {
                "_end": F.sum("_n").over(group.orderBy("_bucket").rowsBetween(*up_to)),
                "_rows": F.sum("_n").over(group),
                "_total": F.sum("_sum").over(group),
                "_first": F.row_number().over(group.orderBy("_bucket")) == 1,
            }
        )
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )
    hit = F.lit(False)
    for position in wanted.values():
        hit = hit | ((F.col("_start") <= position) & (position < F.col("_end")))
    # The first bucket of a group is kept for the totals even if nothing falls in it.
    kept = materialize(buckets.withColumn("_hit", hit).filter("_hit OR _first"))
    targets = kept.filter("_hit").select(*keys, "_bucket", "_start", "_rows")
    bucket = [*keys, "_bucket"]

    in_bucket = Window.partitionBy(*bucket).orderBy("_cents").rowsBetween(*up_to)
    placed = (
        _join_on(counted, targets, bucket, "inner")
        .withColumn("_end", F.col("_start") + F.sum("_count").over(in_bucket))
        .withColumn("_begin", F.col("_end") - F.col("_count"))
    )
    picked = placed.groupBy(*keys).agg(
        *[
            F.max(
                F.when((F.col("_begin") <= position) & (position < F.col("_end")), F.col("_cents"))
            ).alias(name)
            for name, position in wanted.items()
        ]
    )
    groups = kept.filter("_first").select(*keys, "_rows", "_total")
    return _join_on(groups, picked, keys, "left").select(
        *[F.col(key).alias(column) for column, key in zip(by, keys)],
        *[_interpolated(name, point) for name, point in fractions.items()],
        mean_money("_total", "_rows").alias("mean"),
    )


def cost_percentiles(claims: DataFrame) -> DataFrame:
    """Quartiles, 90th percentile and mean of claim cost per region."""
    return grouped_percentiles(claims, ["region"]).orderBy(F.desc("median"), "region")
