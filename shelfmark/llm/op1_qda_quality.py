"""Quality classifier: regularised quadratic discriminant analysis.

Each class gets a mean and a covariance over transformed document statistics; covariances are
shrunk towards the pooled one and towards its diagonal. A score is the posterior from the
difference of the log densities, whose Mahalanobis terms use Cholesky factors that are computed
once. Labels come from the training part only; moments are exact sums over all its labelled
rows, added up per batch before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.linestats import DIGIT, LETTER, PUNCT, STOP, SYMBOL, UPPER, line_stats, repeated_window_words
from shelfmark.llm.words import documents, per_batch, portions
from shelfmark.session import materialize

THRESHOLD = 0.7


def document_features(texts: list[str]) -> np.ndarray:
    """texts x features. Shares enter as log(x + 0.01), sizes as log(1 + x): closer to normal
    than the raw values. An empty text has all counts 0."""
    stats = line_stats(texts)
    n_words, repeated, distinct = repeated_window_words(texts, lower=True)
    by_class = np.stack([stats.per_text(stats.classes[:, k]) for k in range(8)], 1).astype(float)
    words, letters = np.maximum(1, n_words), np.maximum(1, by_class[:, LETTER] + by_class[:, UPPER])
    lines = np.maximum(1, stats.per_text((stats.words > 0).astype(np.int64)))
    shares = [
        by_class[:, UPPER] / letters,
        by_class[:, SYMBOL] / words,
        stats.per_text(stats.doubled) / words,
        stats.per_text(stats.capitals) / words,
        by_class[:, STOP] / words,
        by_class[:, PUNCT] / words,
        by_class[:, DIGIT] / words,
        repeated / words,
        stats.per_text(stats.repeats.astype(np.int64)) / lines,
        distinct / words,
    ]
    sizes = [n_words, lines, letters / words, n_words / lines]
    return np.stack([np.log(x + 0.01) for x in shares] + [np.log1p(x) for x in sizes], 1)


@dataclass
class Qda:
    """Two classes; ``factors`` are inverse Cholesky factors of the covariances."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled_share: float = 0.1, diagonal_share: float = 0.05) -> Qda | None:
        """From the moments of both classes; None unless both have rows."""
        if (counts == 0).any():
            return None
        means = sums / counts[:, None]
        scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = scatter.sum(0) / counts.sum()
        own = scatter / counts[:, None, None]
        cov = (1 - pooled_share) * own + pooled_share * pooled
        # The floor keeps a factor where a statistic has one value throughout.
        diagonal = np.stack([np.diag(np.diag(c)) for c in cov]) + 1e-4 * np.eye(sums.shape[1])
        cov = (1 - diagonal_share) * cov + diagonal_share * diagonal
        chol = np.linalg.cholesky(cov)
        return Qda(means, np.linalg.inv(chol), 2 * np.log(np.diagonal(chol, axis1=1, axis2=2)).sum(1), np.log(counts / counts.sum()))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 of each row."""
        density = [
            self.log_priors[k] - 0.5 * (self.log_dets[k] + (((x - self.means[k]) @ self.factors[k].T) ** 2).sum(1)) for k in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit_qda(features: DataFrame, labels: DataFrame, learn_from=None) -> Qda | None:
    """``features`` (doc_id, x array<double>), ``labels`` (doc_id, quality). Rows with a
    null or other label are left out; a document with two label rows counts twice."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = features if learn_from is None else features.where(learn_from)
    rows = rows.join(known, "doc_id")

    def moments(batch):
        flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
        x, y = flat.reshape(batch.num_rows, -1), batch.column("quality").to_numpy(zero_copy_only=False)
        out = [(k, np.concatenate([[len(p := x[y == k])], p.sum(0), (p.T @ p).ravel()]).tolist()) for k in (0, 1)]
        return {"quality": [k for k, _ in out], "sums": [v for _, v in out]}

    cells = per_batch(rows.select("x", "quality"), moments, "quality int, sums array<double>").select("quality", F.posexplode("sums"))
    width = document_features([""]).shape[1]
    total = np.zeros((2, 1 + width + width * width))  # bounded: a few hundred numbers
    for r in cells.groupBy("quality", "pos").agg(F.sum("col").alias("total")).collect():
        total[r.quality, r.pos] = r.total
    return Qda.fit(total[:, 0], total[:, 1 : 1 + width], total[:, 1 + width :].reshape(2, width, width))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Null text counts as empty; an empty text is scored like any other. Without labels of both
    classes every score is 0.5. Columns other than doc_id and text are not looked at.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))

    def features(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "x": np.concatenate([document_features(part) for part in portions(texts)]).tolist()}

    table = materialize(per_batch(docs.select(F.col("doc_id").cast("long"), "text"), features, "doc_id long, x array<double>"), "quality-features")
    model = fit_qda(table, labels, ~held_out)

    def score(batch):
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return {"doc_id": batch.column("doc_id"), "score": np.full(len(x), 0.5) if model is None else model.scores(x)}

    scored = per_batch(table, score, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op1_qda_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
