"""From raw documents to packed training sequences, in five stages.

Every stage is written as Parquet and read again by the next. All but the last return the
columns of ``documents``; a stage that changes a text brings ``n_chars`` up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.op4_tensored_minhash import Shingling, near_duplicates
from shelfmark.llm.op5_sum_squares_packing import pack_documents
from shelfmark.llm.op8_crf_rules import fit_line_crf, keep_content
from shelfmark.llm.op9_line_join import dedup_lines
from shelfmark.llm.op10_fm_index import find_benchmark
from shelfmark.llm.words import documents, store, without_ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labelling or the base rules reject go. Null texts go too."""
    return keep_content(docs, fit_line_crf(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines go, with the short lines that they hold; so do documents of which
    no word is left by that."""
    out = dedup_lines(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), short=True)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    out = out.where(~F.coalesce(emptied, F.lit(False)))

    def column(name: str):
        old = F.col("row")[name]
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("text")).otherwise(old).cast(docs.schema[name].dataType).alias(name)
        return old.alias(name)

    return out.select(*map(column, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays: shingles of
    five words, similarity 0.8."""
    found = store(near_duplicates(docs, Shingling(words=5)), "near-duplicates")
    return without_ids(docs, found.where(~F.col("kept")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = store(found.where(F.size("spans") > 0).select("doc_id", "spans", "items"), "contaminated")
    return without_ids(docs, hit)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids; one row per piece of a document."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: A conditional random field, MinHash tables and a tokenizer are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
