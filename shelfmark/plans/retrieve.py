"""Two-stage retrieval for a table of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.ann import AnnIndex, search_ann
from shelfmark.operators.embed import check_same_embedder
from shelfmark.operators.rerank import DEFAULT_TOP_N, rerank
from shelfmark.operators.search import DEFAULT_K, similarity_search
from shelfmark.plans.index import index_embedder, index_rows
from shelfmark.session import materialize


def retrieve(
    index: DataFrame | AnnIndex | str,
    questions: DataFrame,
    embedder,
    scorer,
    k: int = DEFAULT_K,
    top_n: int = DEFAULT_TOP_N,
    metric: str = "cosine",
    where: Column | str | None = None,
    columns: tuple[str, ...] = ("pdf_name",),
    text_col: str = "content",
    index_embedder_id: str | None = None,
    nprobe: int = 8,
) -> DataFrame:
    """``k`` similar passages per question, re-scored, the best ``top_n`` kept.

    ``questions`` has ``query_id`` and ``question``. They are embedded by the embedder
    of the index and stored once, since search and re-ranking both read them. An index given
    by name, or an approximate one, knows its embedder, and another is refused; for a
    DataFrame ``index_embedder_id`` says which it was.
    """
    if isinstance(index, str):
        index_embedder_id = index_embedder(questions.sparkSession, index)
        check_same_embedder(index_embedder_id, embedder.embedder_id)
        index = index_rows(questions.sparkSession, index)
    elif isinstance(index, AnnIndex) and index.embedder_id is not None:
        check_same_embedder(index.embedder_id, embedder.embedder_id)
    if index_embedder_id is not None:
        check_same_embedder(index_embedder_id, embedder.embedder_id)
    questions = questions.select("query_id", "question")
    asked = materialize(embedder.transform(questions, "question", "qv", key="query_id"), "questions")
    payload = [*columns, text_col]
    if isinstance(index, AnnIndex):
        hits = search_ann(index, asked, k, nprobe, where, payload)
    else:
        hits = similarity_search(index, asked, k, metric, where, payload)
    ranked = rerank(hits, asked, scorer, text_col)
    return ranked.where(F.col("rank") <= top_n)
