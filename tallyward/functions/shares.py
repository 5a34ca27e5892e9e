"""Shares of a grand total."""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F

from tallyward.functions.money import percent


def share_of_all(part: str) -> Column:
    """`part` as a percentage of its sum over all rows.

    Meant for grouped frames with a handful of categories: the total is a window
    over the groups, never over the rows behind them.
    """
    return percent(part, F.sum(part).over(Window.partitionBy()))
