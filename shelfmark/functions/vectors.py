"""Vector expressions on ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.common import let, run_starts


def vector_fault(vector: Column, dim: int) -> Column:
    """Why a vector cannot be indexed, or NULL when it can."""
    return (
        F.when(vector.isNull(), F.lit("missing"))
        .when(F.size(vector) != dim, F.lit("wrong length"))
        .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit("not finite"))
        .when(F.forall(vector, lambda x: x == 0), F.lit("all zero"))
    )


def unit_vector(entries: Column, dim: int) -> Column:
    """``array<struct<slot int, v double>>`` to a dense unit vector of ``dim`` floats.

    Entries of one slot are added up; NULL when nothing is left. Linear in
    ``dim`` plus the entries, and independent of their order.
    """

    def summed(e: Column) -> Column:
        return let(
            run_starts(e, lambda x: x["slot"]),
            lambda starts: F.transform(
                starts,
                lambda p, j: F.struct(
                    F.get(e, p)["slot"].alias("slot"),
                    F.aggregate(
                        F.slice(e, p + 1, F.coalesce(F.get(starts, j + 1), F.size(e)) - p),
                        F.lit(0.0),
                        lambda acc, x: acc + x["v"],
                    ).alias("v"),
                ),
            ),
        )

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

    def dense(cells: Column) -> Column:
        return let(
            F.sqrt(F.aggregate(cells, F.lit(0.0), lambda acc, x: acc + x["v"] * x["v"])),
            lambda norm: F.when(
                norm > 0,
                F.flatten(
                    F.concat(
                        F.transform(
                            cells,
                            lambda x, i: F.concat(
                                zeros(x["slot"] - F.coalesce(F.get(cells, i - 1)["slot"], F.lit(-1)) - 1),
                                F.array((x["v"] / norm).cast("float")),
                            ),
                        ),
                        F.array(zeros(F.lit(dim - 1) - F.element_at(cells, -1)["slot"])),
                    )
                ),
            ),
        )

    return F.when(F.size(entries) > 0, let(F.sort_array(entries), lambda e: let(summed(e), dense)))


def to_cells(vector: Column) -> Column:
    """Dense vector to its non-zero cells, ``array<struct<slot, v>>``."""
    return F.filter(
        F.transform(vector, lambda x, i: F.struct(i.alias("slot"), x.cast("double").alias("v"))),
        lambda c: c["v"] != 0,
    )
