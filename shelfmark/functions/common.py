"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_starts(ordered: Column, part: Callable[[Column], Column] = lambda x: x) -> Column:
    """0-based positions at which a new value begins in a sorted array."""
    return F.array_compact(
        F.transform(
            ordered,
            lambda x, i: F.when((i == 0) | ~part(x).eqNullSafe(part(F.get(ordered, i - 1))), i),
        )
    )


def as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def unnest(df: DataFrame, keep: list[str], structs: str) -> DataFrame:
    """Array of structs to rows; null and empty arrays give none.

    ``inline_outer`` plus a filter rather than ``inline``: for the latter the optimizer
    copies the array's whole expression into a filter below it, and evaluates it twice.
    """
    fields = df.schema[structs].dataType.elementType.fieldNames()
    opened = df.select(*keep, F.inline_outer(structs))
    return opened.where(F.col(fields[0]).isNotNull()).select(*keep, *fields)
