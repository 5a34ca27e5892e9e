"""Known faults laid over clean claims, so that every quality rule has work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyward.schemas import MONEY


def _every(step: int) -> Column:
    return F.col("claim_id") % step == 0


def with_faults(claims: DataFrame) -> DataFrame:
    """Repeat some claims and damage others; no claim is removed.

    Needs `claim_id`; only columns present in `claims` are damaged, except that
    an overpayment also needs `total_cost`.
    """
    extra = F.when(_every(929), 1).otherwise(0) + F.when(_every(919), 2).otherwise(0)
    repeated = claims.withColumn("_copy", F.explode(F.sequence(F.lit(0), extra))).drop("_copy")

    damage = {
        "patient_id": lambda c: F.when(_every(997), F.lit(None))
        .when(_every(991), F.lit(-1).cast("bigint"))
        .otherwise(c),
        "service_date": lambda c: F.when(~_every(983), c),
        "total_cost": lambda c: F.when(_every(977), F.lit(0).cast(MONEY)).otherwise(c),
        "paid_amount": lambda c: F.when(
            _every(971), (F.col("total_cost") + 10).cast(MONEY)
        )
        .when(_every(967), F.lit(-1).cast(MONEY))
        .otherwise(c),
        "length_of_stay": lambda c: F.when(_every(953), 45).otherwise(c),
        "readmission_30d": lambda c: F.when(_every(947), 2).otherwise(c),
        "region": lambda c: F.when(_every(941), "Unknown").otherwise(c),
        "diagnosis_code": lambda c: F.when(~_every(937), c),
    }
    return repeated.select(
        *[
            damage[name](F.col(name)).alias(name) if name in damage else F.col(name)
            for name in repeated.columns
        ]
    )
