"""Dense surrogate keys without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.common import as_list
from shelfmark.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def assign_ids(
    df: DataFrame,
    order_by: str | list[str] | None = None,
    id_col: str = "id",
    above: int = 0,
) -> DataFrame:
    """Fill missing ids with consecutive numbers; ids that the writer gave are kept.

    Numbers start above both ``above`` and the largest given id. With ``order_by``
    they follow that order (range partitions, then offsets; the input runs twice, once
    for the partitioner's sample); without, they follow the input's, and nothing is shuffled.

    The rows are written once together with their partition and position, because
    those could shift if the plan ran again; the offsets table has one row per
    partition, so its broadcast is bounded by the number of partitions.
    """
    given = None
    if id_col in df.columns:
        df = materialize(df, "ids-in")
        given = df.where(F.col(id_col).isNotNull())
        above = max(above, given.agg(F.max(id_col)).first()[0] or 0)
        df = df.where(F.col(id_col).isNull()).drop(id_col)
    columns = df.columns
    if order_by is not None:
        keys = as_list(order_by)
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "ids")
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    offsets = materialize(offsets, "id-offsets")
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = numbered.select((F.lit(above + 1) + F.col("_before") + row).alias(id_col), *columns)
    if given is None:
        return numbered
    return given.select(id_col, *columns).unionByName(numbered)
