"""Second-stage scoring of (question, passage) pairs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.common import let, unnest
from shelfmark.functions.text import term_counts, tokens
from shelfmark.operators.corpus import CorpusStats
from shelfmark.operators.lookup import NARROW_ROWS, keyed_lookup
from shelfmark.operators.topk import SCORE_DIGITS
from shelfmark.session import ship_package

# Rows kept after re-ranking, and the pair model's input limit in tokens.
DEFAULT_TOP_N = 3
PAIR_TOKENS = 512

_PAIR = ["query_id", "id"]


@dataclass(frozen=True)
class Bm25Scorer:
    """BM25 (Robertson & Zaragoza 2009) with the statistics of the indexed table."""

    stats: CorpusStats
    k1: float = 1.2
    b: float = 0.75

    def score(self, pairs: DataFrame, questions: DataFrame, text_col: str, question_col: str) -> DataFrame:
        """``pairs`` with ``score``; 0 for a pair that shares no known term."""
        asked = self._question_terms(questions, question_col)
        paired = pairs.join(asked, "query_id", "left")

        def pair_score(entries: Column) -> Column:
            length = F.aggregate(entries, F.lit(0), lambda acc, e: acc + e["tf"])
            # Hashed, not searched one by one: both sides may be whole passages.
            shared = F.array_intersect(F.transform(entries, lambda e: e["term"]), F.map_keys("_idf"))
            counts = F.map_from_entries(entries)
            damp = self.k1 * (1 - self.b + self.b * length / self.stats.mean_length)
            gain = lambda tf, idf, d: idf * tf * (self.k1 + 1) / (tf + d)
            add = lambda c, d: F.aggregate(shared, F.lit(0.0), lambda acc, t: acc + gain(F.element_at(c, t), F.element_at("_idf", t), d))
            return let(damp, lambda d: let(counts, lambda c: add(c, d)))

        # Bound once per pair: a plain column would be folded into the lambda and run per term.
        score = let(term_counts(F.col(text_col)), pair_score)
        return paired.withColumn("score", F.coalesce(score, F.lit(0.0))).drop("_idf")

    def _question_terms(self, questions: DataFrame, question_col: str) -> DataFrame:
        """``(query_id, _idf map<term, idf>)`` over the known distinct terms."""
        spark = questions.sparkSession
        listed = questions.select("query_id", term_counts(F.col(question_col)).alias("_e"))
        rows = unnest(listed, ["query_id"], "_e").select("query_id", "term")
        counts = rows.groupBy("term").agg(F.count("*").alias("n"))
        known = keyed_lookup(rows, self.stats.terms(spark).select("term", "idf"), "term", counts, broadcast_facts=NARROW_ROWS)
        # One group is one question, so the map is bounded by that question.
        entries = F.map_from_entries(F.collect_list(F.struct("term", "idf")))
        return known.groupBy("query_id").agg(entries.alias("_idf"))


@dataclass(frozen=True)
class ModelScorer:
    """A user's pair model behind ``predict_batch_udf``.

    ``make_predict`` runs once per task and returns a function of two text arrays.
    A pair over ``max_tokens`` is scored in windows, and its score is the best of
    them, so the end of a long passage counts as well.
    """

    make_predict: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]]
    max_tokens: int = PAIR_TOKENS
    batch_size: int = 64

    def score(self, pairs: DataFrame, questions: DataFrame, text_col: str, question_col: str) -> DataFrame:
        ship_package(pairs.sparkSession)
        asked = pairs.join(questions.select("query_id", question_col), "query_id")
        parts = pair_windows(asked, self.max_tokens, text_col, question_col)
        predict = predict_batch_udf(self.make_predict, return_type=T.DoubleType(), batch_size=self.batch_size)
        scored = parts.withColumn("score", predict(question_col, "part"))
        best = scored.groupBy(*_PAIR).agg(F.max("score").alias("score"))
        return pairs.join(best, _PAIR, "left")


def pair_windows(
    pairs: DataFrame, limit: int = PAIR_TOKENS, text_col: str = "content", question_col: str = "question"
) -> DataFrame:
    """``(query_id, id, question, part_no, part, n_tokens)`` with question + part within ``limit``.

    The windows cover the whole passage. A question that would leave less than an eighth of
    the limit is cut into windows itself, and each meets all windows of the passage.
    """
    most = limit - max(1, limit // 8)
    asked = tokens(F.col(question_col))
    cut = F.when(
        F.size(asked) > most,
        F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(asked) / most).cast("int") - 1),
            lambda i: F.array_join(F.slice(asked, i * most + 1, F.lit(most)), " "),
        ),
    ).otherwise(F.array(F.col(question_col)))
    opened = pairs.select(*_PAIR, text_col, F.explode_outer(cut).alias(question_col))
    room = F.lit(limit) - F.size(tokens(F.coalesce(F.col(question_col), F.lit(""))))
    rows = opened.select(*_PAIR, question_col, tokens(F.col(text_col)).alias("_tok"), room.alias("_room"))
    last = F.greatest(F.lit(0), F.ceil(F.size("_tok") / F.col("_room")).cast("int") - 1)
    parts = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("part_no"),
            F.array_join(F.slice("_tok", i * F.col("_room") + 1, F.col("_room")), " ").alias("part"),
            F.least(F.col("_room"), F.size("_tok") - i * F.col("_room")).alias("n_tokens"),
        ),
    )
    parts = rows.select(*_PAIR, question_col, F.when(F.col("_tok").isNotNull(), parts).alias("_p"))
    return unnest(parts, [*_PAIR, question_col], "_p")


def rerank(
    candidates: DataFrame,
    questions: DataFrame,
    scorer: Bm25Scorer | ModelScorer,
    text_col: str = "content",
    question_col: str = "question",
) -> DataFrame:
    """All candidates in new order: ``rank`` and ``score`` of the scorer, by id when equal.

    The similarity rank stays as ``first_rank``.
    """
    pairs = candidates.withColumnRenamed("rank", "first_rank").drop("score")
    scored = scorer.score(pairs, questions, text_col, question_col)
    scored = scored.withColumn("score", F.round("score", SCORE_DIGITS))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), F.col("id"))
    return scored.withColumn("rank", F.row_number().over(order))
