"""Lookups in small fixed tables, kept inside the projection instead of a join.

The tables are written as SQL literals, which Spark folds into one constant.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def _text(value: object) -> str:
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def quoted(name: str) -> str:
    """A column's name as one part of an expression, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def lookup(key: Column, table: Mapping[str, object], data_type: str = "string") -> Column:
    """Value of `key` in `table`, NULL for an unknown key."""
    pairs = [f"{_text(name)}, CAST({_text(value)} AS {data_type})" for name, value in table.items()]
    return F.try_element_at(F.expr(f"map({', '.join(pairs)})"), key)


def nth_of(position: Column, values: Iterable[str]) -> Column:
    """The `position`-th (0-based) entry of `values`."""
    entries = ", ".join(_text(value) for value in values)
    return F.try_element_at(F.expr(f"array({entries})"), (position + 1).cast("int"))
