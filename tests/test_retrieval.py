from __future__ import annotations

import math
import re

import pytest

from shelfmark.operators.embed import HashEmbedder
from shelfmark.operators.evaluate import evaluate, judge_hits
from shelfmark.operators.prompts import GROUNDING, build_prompts, to_passages
from shelfmark.operators.rerank import Bm25Scorer, ModelScorer, pair_windows, rerank
from shelfmark.plans.retrieve import retrieve

PASSAGES = [
    (1, "a.txt", "spark reads files and makes tables"),
    (2, "b.txt", "tables hold rows, rows hold columns and columns hold values"),
    (3, "c.txt", "nothing to see here"),
    (4, "d.txt", "spark spark spark and tables"),
]


@pytest.fixture(scope="module")
def index(spark):
    df = spark.createDataFrame(PASSAGES, "id long, pdf_name string, content string")
    embedder = HashEmbedder.fit(df, "content", 64)
    return embedder.transform(df), embedder


def bm25(question, passage):
    docs = [re.findall(r"\w+", t) for _, _, t in PASSAGES]
    mean = sum(map(len, docs)) / len(docs)
    words, score = passage.split(), 0.0
    words = re.findall(r"\w+", passage)
    for t in set(re.findall(r"\w+", question.lower())):
        df = sum(t in d for d in docs)
        tf = words.count(t)
        if df and tf:
            idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))
    return round(score, 6)


def test_bm25_keeps_every_candidate(spark, index):
    _, embedder = index
    questions = spark.createDataFrame([(7, "Spark tables?"), (8, "unheard of")], "query_id long, question string")
    candidates = spark.createDataFrame(
        [(q, i, i, 0.5, p, t) for q in (7, 8) for i, p, t in PASSAGES],
        "query_id long, rank int, id long, score double, pdf_name string, content string",
    )
    got = rerank(candidates, questions, Bm25Scorer(embedder.stats)).orderBy("query_id", "rank").collect()
    assert len(got) == 8
    seven = [(r.id, round(r.score, 6)) for r in got if r.query_id == 7]
    want = sorted(((i, bm25("spark tables", t)) for i, _, t in PASSAGES), key=lambda x: (-x[1], x[0]))
    assert seven == want and seven[-1] == (3, 0.0)
    eight = [(r.id, r.score, r.first_rank) for r in got if r.query_id == 8]
    assert [x[0] for x in eight][:1] == [1] or eight[0][1] > 0
    assert len(eight) == 4


def test_model_sees_whole_passages(spark):
    long = " ".join(["x"] * 40 + ["needle"])
    pairs = spark.createDataFrame([(1, 1, 1, 0.1, long), (1, 2, 2, 0.0, "x x")], "query_id long, rank int, id long, score double, content string")
    questions = spark.createDataFrame([(1, "find the needle")], "query_id long, question string")

    def make():
        import numpy as np

        return lambda q, p: np.array([float("needle" in t) for t in p])

    got = rerank(pairs, questions, ModelScorer(make, max_tokens=10)).orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [(1, 1.0), (2, 0.0)]


def test_pair_windows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    pairs = spark.createDataFrame([(1, 1, text, "a b c"), (1, 2, "", "a b c"), (1, 3, "z", "q " * 30)], "query_id long, id long, content string, question string")
    rows = pair_windows(pairs, 10).orderBy("id", "part_no").collect()
    assert [r.n_tokens for r in rows if r.id == 1] == [7, 7, 6]
    assert " ".join(r.part for r in rows if r.id == 1) == text
    # A question of 30 tokens is four windows of at most 9 itself.
    assert [(r.id, r.n_tokens) for r in rows if r.id != 1] == [(2, 0)] + [(3, 1)] * 4


def test_two_stages(spark, index):
    df, embedder = index
    questions = spark.createDataFrame([(1, "spark files"), (2, "rows and columns"), (3, "qqq")], "query_id long, question string")
    got = retrieve(df, questions, embedder, Bm25Scorer(embedder.stats), k=3, top_n=2).collect()
    best = {r.query_id: r.pdf_name for r in got if r["rank"] == 1}
    assert best == {1: "a.txt", 2: "b.txt"}
    assert all(r["rank"] <= 2 for r in got)
    with pytest.raises(ValueError):
        retrieve(df, questions, embedder, Bm25Scorer(embedder.stats), index_embedder_id="other")


def test_passages_and_prompts(spark):
    queries = spark.createDataFrame([(1, "Why?"), (2, "How?")], "query_id long, question string")
    hits = spark.createDataFrame([(1, 2, "b", "two"), (1, 1, "a", "one")], "query_id long, rank int, pdf_name string, content string")
    passages = to_passages(queries, hits)
    got = {r.query_id: [(p.file, p.text) for p in r.passages] for r in passages.collect()}
    assert got == {1: [("a", "one"), ("b", "two")], 2: []}
    prompts = {r.query_id: r for r in build_prompts(queries, passages).collect()}
    assert prompts[1].prompt == 'Why?\n\n**Context:** "one\n\ntwo"' and prompts[1].has_context
    assert prompts[2].prompt == "How?" and not prompts[2].has_context and prompts[2].system == GROUNDING


def test_evaluation(spark):
    questions = spark.createDataFrame(
        [(1, "alpha beta", "simple"), (2, "gamma", "simple"), (3, "Delta, eps", "reasoning")],
        "query_id long, ground_truth string, evolution_type string",
    )
    hits = spark.createDataFrame(
        [(1, 1, "beta alone"), (1, 2, "see Alpha  beta."), (3, 1, "delta only"), (3, 2, "none"), (3, 3, "delta eps")],
        "query_id long, rank int, content string",
    )
    judged = {r.query_id: (r.first_hit, r.recall) for r in judge_hits(questions, hits).collect()}
    assert judged == {1: (2, 1.0), 2: (None, 0.0), 3: (3, 1.0)}
    report = {r.evolution_type: r for r in evaluate(questions, hits, 2).collect()}
    assert (report["simple"].hit_at_k, report["simple"].mrr, report["simple"].recall) == (0.5, 0.25, 0.5)
    assert (report["reasoning"].hit_at_k, report["reasoning"].recall) == (0.0, 0.5)


def test_a_long_question_is_cut_as_well(spark):
    question, passage = " ".join(f"q{i}" for i in range(50)), " ".join(f"p{i}" for i in range(40))
    pairs = spark.createDataFrame([(1, 1, passage, question), (1, 2, passage, "short one"), (1, 3, "", question)], "query_id long, id long, content string, question string")
    parts = pair_windows(pairs, 16).collect()
    sizes = [len(r.question.split()) + r.n_tokens for r in parts]
    assert max(sizes) <= 16
    long = [r for r in parts if r.id == 1]
    assert {w for r in long for w in r.question.split()} == set(question.split())
    for asked in {r.question for r in long}:
        assert " ".join(r.part for r in sorted(long, key=lambda r: r.part_no) if r.question == asked) == passage
    assert sum(r.id == 2 for r in parts) == 3
