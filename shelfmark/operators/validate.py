"""Fixed vector length and other conditions of an indexable row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.vectors import vector_fault


def validate_vectors(df: DataFrame, dim: int, vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``(valid rows, rejected rows with a reason column)``; both lazy and row-local."""
    fault = vector_fault(F.col(vector_col), dim)
    return df.where(fault.isNull()), df.withColumn("reason", fault).where(F.col("reason").isNotNull())
