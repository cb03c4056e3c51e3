"""Classifier, quality rules and language model against brute force and on odd input."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest
from conftest import TESTDATA

from shelfmark.llm import op6_katz_backoff as katz
from shelfmark.llm.linestats import SYMBOLS, line_stats, repeated_window_words
from shelfmark.llm.op1_qda_quality import Qda, op1_qda_quality, quality_scores
from shelfmark.llm.op8_crf_rules import LineCrf, fit_line_crf, keep_content, label_documents, op8_line_crf
from shelfmark.llm.words import documents

ODD = "doc_id long, text string, score double, kept boolean, quality int, learn boolean, batch long, words string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names the operators use."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (5, long), (6, "née 日本 \U0001f600 ### x"), (None, "a b c d e f g h i j k")]
    return spark.createDataFrame([(i, t, 0.5, True, 7, None, None, "x") for i, t in texts], ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def plain_rules(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        doubled += line in seen and bool(re.search(r"[^\x20\x09-\x0d]", line))
        seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in SYMBOLS), doubled, len(hit)


def test_rules_equal_plain_ones(spark):
    docs = documents(spark, str(TESTDATA)).toPandas().set_index("doc_id").text
    rows = op8_line_crf(spark, str(TESTDATA)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_rules(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert not (r.kept and r.base_failed)


def test_rules_on_odd_rows(spark, odd, none, no_labels):
    crf = fit_line_crf(odd, no_labels)
    assert crf is None
    rows = label_documents(odd, crf).collect()
    assert len(rows) == 8 and {r.n_words for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert all(plain_rules("née 日本 \U0001f600 ### x") == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows if r.doc_id == 6)
    assert label_documents(none, crf).count() == 0
    kept = keep_content(odd, crf)
    assert kept.columns == odd.columns and [r.doc_id for r in kept.collect()] == [None]


def paths(crf, features):
    """Log weights of all label sequences of one text."""
    n = len(features)
    for code in range(2**n):
        labels = [code >> i & 1 for i in range(n)]
        score = crf.begin[labels[0]] + sum(features[i] @ crf.emit[:, labels[i]] for i in range(n))
        yield labels, score + sum(crf.move[labels[i], labels[i + 1]] for i in range(n - 1))


def test_viterbi_finds_the_best_of_all_sequences():
    rng = np.random.default_rng(1)
    crf = LineCrf(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    sizes = [1, 4, 7, 2, 1, 6]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    features = rng.normal(size=(offsets[-1], 3))
    found = crf.decode(features, offsets)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        assert found[a:b].tolist() == max(paths(crf, features[a:b]), key=lambda p: p[1])[0]


def test_gradient_equals_enumeration():
    rng = np.random.default_rng(2)
    crf = LineCrf(rng.normal(size=(2, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    features, labels, offsets = rng.normal(size=(5, 2)), np.array([0, 1, 1, 0, 1]), np.array([0, 3, 5])

    def likelihood(w):
        c = LineCrf(w[:4].reshape(2, 2), w[4:8].reshape(2, 2), w[8:])
        total = 0.0
        for a, b in ((0, 3), (3, 5)):
            scored = list(paths(c, features[a:b]))
            total += next(s for x, s in scored if x == labels[a:b].tolist()) - math.log(sum(math.exp(s) for _, s in scored))
        return total

    w = np.concatenate([crf.emit.ravel(), crf.move.ravel(), crf.begin])
    steps = np.eye(len(w)) * 1e-5
    slopes = [(likelihood(w + s) - likelihood(w - s)) / 2e-5 for s in steps]
    assert np.allclose(crf._gradient(features, offsets, labels), slopes, atol=1e-6)


def test_held_out_accuracy(spark):
    sf = str(TESTDATA).replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = op1_qda_quality(spark, sf).join(labels, "doc_id").where("held_out").toPandas()
    assert len(scored) > 50 and ((scored.score >= 0.7) == scored.predicted).all()
    assert (scored.predicted == scored.quality).mean() > 0.95
    rules = op8_line_crf(spark, sf).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert (rules.kept == (rules.quality == 1)).mean() > 0.95


def test_held_out_labels_are_not_used(spark):
    """Turning the labels of the held-out rows around changes no score."""
    docs, labels = documents(spark, str(TESTDATA)), spark.read.parquet(f"{TESTDATA}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = (quality_scores(docs, x).toPandas().set_index("doc_id").score for x in (labels, turned))
    assert np.allclose(a, b[a.index])


def test_scores_of_odd_rows(spark, odd, none, no_labels):
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    assert {r.score for r in quality_scores(odd, no_labels).collect()} == {0.5}
    rows = quality_scores(odd.unionByName(documents(spark, str(TESTDATA)), allowMissingColumns=True), labels).collect()
    assert len(rows) == 208 and all(0 <= r.score <= 1 for r in rows)
    assert quality_scores(none, labels).count() == 0


def test_discriminant_equals_densities():
    rng = np.random.default_rng(3)
    x = [rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3)) + k for k in (0, 1)]
    model = Qda.fit(np.array([200.0, 200.0]), np.stack([p.sum(0) for p in x]), np.stack([p.T @ p for p in x]), 0, 0)
    logs = []
    for p in x:
        cov, away = np.cov(p.T, bias=True), x[0] - p.mean(0)
        logs.append(-0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away)))
    assert np.allclose(model.scores(x[0]), 1 / (1 + np.exp(logs[0] - logs[1])))


# ------------------------------------------------------------------ language model


def plain_katz(docs):
    """Scores and probabilities by dictionaries."""
    words, pairs, history = collections.Counter(), collections.Counter(), collections.Counter()
    for tokens, learn in docs:
        if learn:
            before = [b"\r", *tokens[:-1]]
            words.update(tokens)
            history.update(before)
            pairs.update(zip(before, tokens, strict=True))
    k, n = katz.GOOD_TURING_MAX, sum(words.values())
    few = [np.bincount([min(c, k + 2) for c in x.values()] or [0], minlength=k + 3) for x in (words, pairs)]
    d1, d2 = map(katz.discounts, few)
    cut = lambda c, d: c * (d[c] if c <= k else 1)
    kept = sum(cut(c, d1) for c in words.values())
    unknown = max(1 - kept / n, 1 / (n + 1)) if n else 1
    word = lambda w: cut(words[w], d1) * (1 - unknown) / kept if w in words else unknown
    mass, lower = collections.Counter(), collections.Counter()
    for (h, w), c in pairs.items():
        mass[h] += cut(c, d2)
        lower[h] += word(w)
    total = lambda h: history[h] + (mass[h] >= history[h] - 1e-9)

    def pair(h, w):
        if (h, w) in pairs:
            return cut(pairs[h, w], d2) / total(h)
        return word(w) * ((1 - mass[h] / total(h)) / (1 - lower[h]) if h in history else 1)

    return words, n, pair, list(history)


def test_scores_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(katz, "BATCH_TOKENS", 20_000)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 5_000)
    texts = documents(spark, str(TESTDATA)).toPandas().set_index("doc_id").text
    docs = {i: (t.encode().translate(katz.LOWER_AZ).split() + [b"\n"], zlib.crc32(str(i).encode()) % 7 != 2) for i, t in texts.items()}
    words, n, pair, history = plain_katz(docs.values())
    rows = katz.op6_katz_backoff(spark, str(TESTDATA)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        tokens, learn = docs[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), sum(w in words for w in tokens), n, not learn)
        assert math.isclose(r.base_score, sum(math.log10((words[w] + 1) / (n + len(words) + 1)) for w in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(pair(h, w)) for h, w in zip([b"\r", *tokens[:-1]], tokens, strict=True)), rel_tol=1e-9)
    for h in history[:: max(1, len(history) // 20)]:
        assert math.isclose(sum(pair(h, w) for w in words) + pair(h, b"never seen"), 1, rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_on_odd_rows(spark, odd, none):
    from pyspark.sql import functions as F

    rows = katz.katz_scores(odd, F.col("doc_id") != 5).collect()
    assert len(rows) == 8 and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1} and all(math.isfinite(r.score) for r in rows)
    untrained = katz.katz_scores(odd, F.lit(False)).collect()
    assert len(untrained) == 8 and {r.train_tokens for r in untrained} == {0} and {r.score for r in untrained} == {0.0}
    assert katz.katz_scores(none, F.lit(True)).count() == 0


def test_packing_of_arrays():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (katz.unpack_keys(katz.pack_keys(keys), 1000) == keys).all()
    for kind in (np.uint32, np.float64):
        values = rng.integers(0, 9, 77).astype(kind)
        assert (katz.unpack(katz.pack(values), kind, 77) == values).all()
    assert len(katz.unpack(katz.pack(np.zeros(0, np.uint32)), np.uint32, 0)) == 0


def test_statistics_of_no_text():
    assert len(line_stats([""]).words) == 1 and repeated_window_words([""])[0].tolist() == [0]
