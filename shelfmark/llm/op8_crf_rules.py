"""Quality rules by line sequence labelling.

A linear-chain conditional random field with two labels, content and boilerplate, is fitted
by maximum likelihood and decoded with the Viterbi algorithm over the lines of a text. The
share of words in content lines decides whether the text is kept.

Lines carry no labels of their own. As weak supervision each line takes the quality label of
its document, over at most ``max_train_docs`` labelled documents (bounded, on the driver;
features only, no text). Fitted weights are a few dozen numbers and go to the tasks by value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import forget_pieces
from shelfmark.llm.linestats import DIGIT, LETTER, NEWLINE, PUNCT, SPACE, STOP, SYMBOL, UPPER, LineStats, line_stats, repeated_window_words
from shelfmark.llm.words import documents, per_batch, portions
from shelfmark.session import ship_package

BOILERPLATE, CONTENT = 0, 1
#: Bound of the labelled sample that the field is fitted on.
MAX_TRAIN_DOCS = 3000
#: Rows whose texts ``keep_content`` holds as Python strings at a time.
KEEP_ROWS = 1000


def line_features(stats: LineStats) -> np.ndarray:
    """lines x features; every value lies in a small range, so one step size suits all."""
    c = stats.classes.astype(np.float64)
    chars = c.sum(1) - c[:, SPACE] - c[:, NEWLINE]
    share = lambda x: x / np.maximum(1, chars)
    per_word = lambda x: np.minimum(2, x / np.maximum(1, stats.words))
    letters = np.maximum(1, c[:, LETTER] + c[:, UPPER])
    return np.stack(
        [
            np.ones(len(c)),
            np.log1p(stats.words) / 4,
            c[:, UPPER] / letters,
            share(c[:, SYMBOL]),
            per_word(c[:, SYMBOL]),
            share(c[:, DIGIT]),
            share(c[:, PUNCT]),
            per_word(c[:, STOP]),
            per_word(stats.doubled),
            per_word(stats.capitals),
            np.minimum(2, letters / np.maximum(1, stats.words) / 10),
            stats.repeats.astype(np.float64),
            (stats.words == 0).astype(np.float64),
            (stats.words < 4).astype(np.float64),
        ],
        1,
    )


@dataclass
class LineCrf:
    """Weights: ``emit`` features x 2, ``move`` 2 x 2 (from, to), ``begin`` 2."""

    emit: np.ndarray
    move: np.ndarray
    begin: np.ndarray

    def decode(self, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Best label of each line. Texts advance together, the longest first, so each
        step is one vector operation over the texts that still have lines."""
        scores = features @ self.emit
        labels = np.zeros(len(scores), np.int8)
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        first, sizes = offsets[:-1][order], sizes[order]
        back = np.zeros((len(scores), 2), np.int8)
        n = int(np.searchsorted(-sizes, 0, "left"))
        best = self.begin + scores[first[:n]]
        final = np.zeros((n, 2))
        step = 1
        while n:
            alive = int(np.searchsorted(-sizes, -step, "left"))
            final[alive:n] = best[alive:n]
            n = alive
            if not n:
                break
            options = best[:n, :, None] + self.move[None]
            back[first[:n] + step] = options.argmax(1)
            best = options.max(1) + scores[first[:n] + step]
            step += 1
        n = int(np.searchsorted(-sizes, 0, "left"))
        state = final.argmax(1)
        for step in range(int(sizes[0]) - 1 if n else -1, -1, -1):
            n = int(np.searchsorted(-sizes, -step, "left"))
            at = first[:n] + step
            labels[at] = state[:n]
            state[:n] = np.take_along_axis(back[at], state[:n, None].astype(np.int64), 1)[:, 0]
        return labels

    @staticmethod
    def fit(features: np.ndarray, offsets: np.ndarray, labels: np.ndarray, rounds: int = 120, l2: float = 1e-3) -> LineCrf:
        """Maximum likelihood by Adam on the exact gradient (forward-backward)."""
        f = features.shape[1]
        weights = np.zeros(2 * f + 6)
        mean, var = np.zeros_like(weights), np.zeros_like(weights)
        for t in range(1, rounds + 1):
            crf = LineCrf(weights[: 2 * f].reshape(f, 2), weights[2 * f : 2 * f + 4].reshape(2, 2), weights[2 * f + 4 :])
            grad = crf._gradient(features, offsets, labels) / max(1, len(labels)) - l2 * weights
            mean, var = 0.9 * mean + 0.1 * grad, 0.99 * var + 0.01 * grad**2
            weights = weights + 0.15 * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.99**t)) + 1e-8)
        return LineCrf(weights[: 2 * f].reshape(f, 2), weights[2 * f : 2 * f + 4].reshape(2, 2), weights[2 * f + 4 :])

    def _gradient(self, features: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Observed minus expected counts of all weights."""
        scores = features @ self.emit
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        first, sizes = offsets[:-1][order], sizes[order]
        longest = int(sizes[0]) if len(sizes) else 0
        forward, norm = np.zeros_like(scores), np.zeros(len(scores))
        counts = [int(np.searchsorted(-sizes, -t, "left")) for t in range(longest + 1)]
        move = np.exp(self.move)
        for t in range(longest):
            at = first[: counts[t]] + t
            prior = np.broadcast_to(np.exp(self.begin), (len(at), 2)) if t == 0 else forward[at - 1] @ move
            peak = scores[at].max(1, keepdims=True)
            value = prior * np.exp(scores[at] - peak)
            norm[at] = value.sum(1)
            forward[at] = value / norm[at][:, None]
        observed_move, expected_move = np.zeros((2, 2)), np.zeros((2, 2))
        backward = np.ones_like(scores)
        for t in range(longest - 1, 0, -1):
            at = first[: counts[t]] + t
            local = np.exp(scores[at] - scores[at].max(1, keepdims=True)) * backward[at] / norm[at][:, None]
            pair = forward[at - 1][:, :, None] * move[None] * local[:, None, :]
            expected_move += (pair / pair.sum((1, 2))[:, None, None]).sum(0)
            backward[at - 1] = local @ move.T
        posterior = forward * backward
        posterior /= np.maximum(1e-300, posterior.sum(1, keepdims=True))
        truth = np.eye(2)[labels]
        inner = np.ones(len(labels), bool)
        inner[first[: counts[0]]] = False
        at = np.flatnonzero(inner)
        np.add.at(observed_move, (labels[at - 1], labels[at]), 1)
        return np.concatenate([(features.T @ (truth - posterior)).ravel(), (observed_move - expected_move).ravel(), (truth - posterior)[~inner].sum(0)])


def training_part(doc_id) -> F.Column:
    """Rows that labels may be learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def fit_line_crf(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> LineCrf | None:
    """Fit on the lines of at most ``max_train_docs`` labelled documents, half of either class.

    None when the sample lacks a class: then nothing can be learned, and every line counts
    as content. The sample is the first rows by hash of the id, so that it does not depend on
    the layout of the tables.
    """
    chosen = []
    for quality in (0, 1):
        rows = labels.where((F.col("quality") == quality) & training_part(F.col("doc_id"))).select("doc_id", "quality").distinct()
        chosen.append(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs // 2))
    sample = chosen[0].unionByName(chosen[1])  # bounded, hence broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def features(batch):
        lines = []
        for part in portions([t or "" for t in batch.column("text").to_pylist()]):
            stats = line_stats(part)
            matrix, offsets = line_features(stats).astype(np.float32), stats.line_offsets
            lines += [matrix[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return {"quality": batch.column("quality"), "lines": lines}

    rows = per_batch(texts, features, "quality int, lines binary").limit(2 * max_train_docs).collect()
    if len({r.quality for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (r.quality, bytes(r.lines)))
    width = line_features(line_stats([""])).shape[1]
    parts = [np.frombuffer(r.lines, np.float32).reshape(-1, width) for r in rows]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    truth = np.repeat([r.quality for r in rows], [len(p) for p in parts])
    return LineCrf.fit(np.concatenate(parts).astype(np.float64), offsets, truth)


def judge_texts(texts: list[str], crf: LineCrf | None, min_content: float) -> dict[str, np.ndarray]:
    """Base rules and the verdict of the field for each text; there must be one."""
    parts = [_judge(part, crf, min_content) for part in portions(texts)]
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _judge(texts: list[str], crf: LineCrf | None, min_content: float) -> dict[str, np.ndarray]:
    stats = line_stats(texts)
    n_words, repeated, _ = repeated_window_words(texts)
    labels = np.full(len(stats.words), CONTENT) if crf is None else crf.decode(line_features(stats), stats.line_offsets)
    share = stats.per_text(stats.words * (labels == CONTENT)) / np.maximum(1, n_words)
    failed = (n_words < 10) | (100 * repeated > 20 * n_words)
    chars = stats.classes.sum(1) - stats.classes[:, SPACE] - stats.classes[:, NEWLINE]
    return {
        "n_words": n_words,
        "word_chars": stats.per_text(chars),
        "n_symbols": stats.per_text(stats.classes[:, SYMBOL]),
        "n_dup_lines": stats.per_text(stats.repeats.astype(np.int64)),
        "n_repeat_words": repeated,
        "base_failed": failed,
        "kept": ~failed & (share >= min_content),
        "content_share": share,
    }


def label_documents(docs: DataFrame, crf: LineCrf | None, min_content: float = 0.5) -> DataFrame:
    """What the base rules and the field say of every row of ``docs`` (doc_id, text).

    Null and empty texts have no word and fail the base rules. Repeated rows are judged each
    on its own; all columns other than doc_id and text are ignored. ``content_share`` is the
    share of words in content lines, 0 without words.
    """

    def judge(batch):
        found = judge_texts([t or "" for t in batch.column("text").to_pylist()], crf, min_content)
        return {"doc_id": batch.column("doc_id")} | found

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"
    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), judge, schema)


def keep_content(docs: DataFrame, crf: LineCrf | None, min_content: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass."""
    ship_package(docs.sparkSession)

    def keep(batches):
        # A worker lives on from job to job, with the pieces that it has encoded for an earlier one.
        forget_pieces()
        for batch in batches:
            for start in range(0, batch.num_rows, KEEP_ROWS):
                part = batch.slice(start, KEEP_ROWS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(judge_texts(texts, crf, min_content)["kept"]))

    return docs.mapInArrow(keep, docs.schema)


def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return label_documents(docs, fit_line_crf(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
