"""Passages and grounded prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed format: the question, a blank line, then the passages in quotes.
PROMPT_HEAD = '\n\n**Context:** "'
PROMPT_TAIL = '"'
PASSAGE_BREAK = "\n\n"

GROUNDING = (
    "Answer from the context given with the question and from nothing else. "
    "If the context does not hold the answer, or there is none, say that you do not know."
)


def to_passages(
    queries: DataFrame, hits: DataFrame, file_col: str = "pdf_name", text_col: str = "content"
) -> DataFrame:
    """``(query_id, passages array<struct<file, text>>)`` in rank order.

    A query without hits has an empty array. A group holds the k hits of one query.
    """
    passage = F.struct(F.col(file_col).alias("file"), F.col(text_col).alias("text"))
    grouped = hits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), passage.alias("p")))).alias("_ranked")
    )
    grouped = grouped.select("query_id", F.transform("_ranked", lambda x: x["p"]).alias("passages"))
    joined = queries.select("query_id").join(grouped, "query_id", "left")
    none = F.array().cast("array<struct<file:string,text:string>>")
    return joined.withColumn("passages", F.coalesce("passages", none))


def build_prompts(
    queries: DataFrame, passages: DataFrame, system: str = GROUNDING, question_col: str = "question"
) -> DataFrame:
    """``(query_id, system, prompt, has_context)``; without passages the prompt is the question.

    ``has_context`` lets such questions be answered "do not know" without a model.
    """
    texts = F.array_join(F.transform("passages", lambda p: p["text"]), PASSAGE_BREAK)
    context = F.concat(F.lit(PROMPT_HEAD), texts, F.lit(PROMPT_TAIL))
    has_context = F.size("passages") > 0
    rows = queries.select("query_id", question_col).join(passages, "query_id")
    return rows.select(
        "query_id",
        F.lit(system).alias("system"),
        F.concat(F.col(question_col), F.when(has_context, context).otherwise("")).alias("prompt"),
        has_context.alias("has_context"),
    )
