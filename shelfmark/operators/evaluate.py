"""Retrieval quality over a question set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import terms


def judge_hits(questions: DataFrame, hits: DataFrame, text_col: str = "content") -> DataFrame:
    """Per question: ``first_hit`` (rank of the first relevant hit) and ``recall``.

    A hit is relevant when its text holds ``ground_truth`` word for word, white space
    and case aside. ``recall`` is the share of the distinct ground-truth terms found in
    the question's hits. Only retrieved pairs are compared; each group is one query's hits.
    """
    flat = lambda c: F.array_join(terms(F.col(c)), " ")
    found = hits.select("query_id", "rank", F.col(text_col).alias("_text"))
    pairs = questions.select("query_id", "ground_truth").join(found, "query_id", "left")
    pairs = pairs.select(
        "query_id",
        "rank",
        F.array_distinct(terms(F.col("ground_truth"))).alias("_truth"),
        F.array_distinct(terms(F.col("_text"))).alias("_seen"),
        F.concat(F.lit(" "), flat("_text"), F.lit(" ")).contains(
            F.concat(F.lit(" "), flat("ground_truth"), F.lit(" "))
        ).alias("_relevant"),
    )
    shared = F.array_intersect("_truth", F.coalesce("_seen", F.array().cast("array<string>")))
    per_query = pairs.groupBy("query_id").agg(
        F.min(F.when(F.col("_relevant"), F.col("rank"))).cast("bigint").alias("first_hit"),
        F.size(F.array_distinct(F.flatten(F.collect_list(shared)))).alias("_found"),
        F.max(F.size("_truth")).alias("_wanted"),
    )
    recall = F.when(F.col("_wanted") > 0, F.col("_found") / F.col("_wanted")).alias("recall")
    return per_query.select("query_id", "first_hit", recall)


def evaluate(
    questions: DataFrame, hits: DataFrame, k: int, group_col: str = "evolution_type", text_col: str = "content"
) -> DataFrame:
    """Per group: ``n_questions``, ``hit_at_k``, ``mrr`` and ``recall``, as means over questions."""
    judged = judge_hits(questions, hits.where(F.col("rank") <= k), text_col)
    rows = questions.select("query_id", group_col).join(judged, "query_id")
    return rows.groupBy(group_col).agg(
        F.count("*").alias("n_questions"),
        F.avg(F.col("first_hit").isNotNull().cast("double")).alias("hit_at_k"),
        F.avg(F.coalesce(1 / F.col("first_hit"), F.lit(0.0))).alias("mrr"),
        F.avg("recall").alias("recall"),
    )
