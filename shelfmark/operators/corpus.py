"""Corpus statistics: document frequencies and lengths, fitted once and stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import term_sign, term_slot, terms
from shelfmark.session import scratch_path

_TOTAL = ""  # no term is empty, so the empty string can count the rows
_SCHEMA = "term string, df bigint, length bigint"


@dataclass(frozen=True)
class CorpusStats:
    """Document frequency of each term at ``path``, with the totals."""

    path: str
    n_docs: int
    n_terms: int
    term_bytes: int
    total_length: int
    fingerprint: str

    @property
    def mean_length(self) -> float:
        return self.total_length / self.n_docs if self.n_docs else 0.0

    def idf(self, df: Column) -> Column:
        return F.log(1 + (F.lit(float(self.n_docs)) - df + 0.5) / (df + 0.5))

    def terms(self, spark: SparkSession) -> DataFrame:
        """``(term, df, idf)``."""
        table = spark.read.schema(_SCHEMA).parquet(self.path).where(F.col("term") != _TOTAL)
        return table.select("term", "df", self.idf(F.col("df")).alias("idf"))

    def signed_terms(self, spark: SparkSession, dim: int) -> DataFrame:
        """``(term, df, slot, weight)``: hash slot and signed idf of each term."""
        return self.terms(spark).select(
            "term",
            "df",
            term_slot(F.col("term"), dim).alias("slot"),
            (term_sign(F.col("term")) * F.col("idf")).alias("weight"),
        )


def fit_corpus(df: DataFrame, text_col: str = "content", path: str | None = None) -> CorpusStats:
    """Count terms over all rows of ``df`` in one pass and store the result.

    Each row also counts once under the empty term, with its length, so the number of rows
    and their total length come out of the same aggregation. Counting is pre-aggregated
    before the shuffle, so a term present in every row is no hot key.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "terms")
    none = F.array().cast("array<string>")
    found = df.select(F.coalesce(terms(F.col(text_col)), none).alias("_t"))
    rows = found.select(
        F.size("_t").alias("_n"),
        F.explode_outer(F.concat(F.array(F.lit(_TOTAL)), F.array_distinct("_t"))).alias("term"),
    )
    length = F.sum(F.when(F.col("term") == _TOTAL, F.col("_n"))).cast("bigint")
    counted = rows.groupBy("term").agg(F.count("*").alias("df"), length.alias("length"))
    counted.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(_SCHEMA).parquet(path)
    is_term = F.col("term") != _TOTAL
    total = stored.agg(
        F.coalesce(F.sum(F.when(~is_term, F.col("df"))), F.lit(0)).alias("n_docs"),
        F.count(F.when(is_term, 1)).alias("n_terms"),
        F.coalesce(F.sum(F.when(is_term, F.octet_length("term"))), F.lit(0)).alias("term_bytes"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_length"),
        F.hex(F.coalesce(F.bit_xor(F.xxhash64("term", "df")), F.lit(0))).alias("fingerprint"),
    ).first()
    return CorpusStats(path, *total)
