from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators.corpus import fit_corpus
from shelfmark.operators.embed import HashEmbedder, ModelEmbedder, check_same_embedder
from shelfmark.operators.ids import assign_ids
from shelfmark.operators.lookup import keyed_lookup
from shelfmark.operators.validate import validate_vectors
from shelfmark.session import arrow_batch_rows

TEXTS = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "", None, "zebra zebra the"]


def corpus(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id long, content string")


def brute(texts, asked, dim):
    docs = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    out = []
    for text in asked:
        v = np.zeros(dim)
        terms = re.findall(r"[^\W_]+", (text or "").lower())
        for t in set(terms) & set(df):
            h = hashlib.md5(t.encode()).hexdigest()
            idf = math.log(1 + (len(texts) - df[t] + 0.5) / (df[t] + 0.5))
            v[int(h[:8], 16) % dim] += (1 if h[8] < "8" else -1) * (1 + math.log(terms.count(t))) * idf
        out.append(v / np.linalg.norm(v) if v.any() else None)
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_terms": 0}, {"broadcast_terms": 0, "hot_keys": 3, "broadcast_facts": 0}])
def test_fitted_vectors(spark, options):
    """Broadcast, small join and the split of hot and other terms all agree with the rule."""
    df = corpus(spark)
    embedder = HashEmbedder.fit(df, "content", 32)
    asked = TEXTS + ["unseen words only", "cat unseen"]
    rows = embedder.transform(corpus(spark, asked), key="id", **options).orderBy("id").collect()
    for row, want in zip(rows, brute(TEXTS, asked, 32)):
        if want is None:
            assert row.embedding is None
        else:
            assert np.allclose(row.embedding, want, atol=1e-6)


def test_corpus_statistics(spark):
    stats = fit_corpus(corpus(spark))
    assert (stats.n_docs, stats.total_length) == (6, 17)
    got = {r.term: r.df for r in stats.terms(spark).collect()}
    assert got["the"] == 3 and got["zebra"] == 1 and "" not in got
    assert stats.n_terms == len(got)


def test_plain_vectors(spark):
    rows = HashEmbedder(8).transform(corpus(spark)).orderBy("id").collect()
    assert [r.embedding is None for r in rows] == [False, False, False, True, True, False]
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-6 and len(r.embedding) == 8 for r in rows if r.embedding)


def test_refit_has_a_new_name(spark):
    a = HashEmbedder.fit(corpus(spark), dim=16)
    b = HashEmbedder.fit(corpus(spark), dim=16)
    c = HashEmbedder.fit(corpus(spark, ["other"]), dim=16)
    assert a.embedder_id == b.embedder_id != c.embedder_id
    check_same_embedder(a.embedder_id, b.embedder_id)
    with pytest.raises(ValueError):
        check_same_embedder(a.embedder_id, c.embedder_id)




@pytest.mark.parametrize(("cap", "most"), [(10, 10), (10_000, 150)])
def test_requests_are_bounded(spark, cap, most):
    df = spark.range(400).repartition(1).selectExpr("id", "concat('t', id) AS content")

    def make():
        return lambda texts: np.array([[len(texts), len(t)] for t in texts], dtype=np.float32)

    with arrow_batch_rows(spark, cap):
        rows = ModelEmbedder("sizes", make, 2).transform(df).collect()
    assert len(rows) == 400
    assert max(r.embedding[0] for r in rows) == most
    assert all(r.embedding[1] == len(r.content) for r in rows)


def test_error_policy(spark):
    def make():
        def predict(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("refused")
            return np.ones((len(texts), 2), dtype=np.float32)

        return predict

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "id int, content string").repartition(1)
    model = ModelEmbedder("m", make, 2, batch_size=1, on_error="null")
    got = {r.id: r.embedding for r in model.transform(df).collect()}
    assert got == {1: [1.0, 1.0], 2: None, 3: None}
    with pytest.raises(Exception, match="refused"):
        ModelEmbedder("m", make, 2, batch_size=1).transform(df).collect()


def test_validate(spark):
    nan = float("nan")
    rows = [(1, None), (2, [1.0]), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [0.0, 1.0]), (7, [float("inf"), 1.0])]
    valid, rejects = validate_vectors(spark.createDataFrame(rows, "id int, embedding array<float>"), 2)
    assert [r.id for r in valid.collect()] == [6]
    assert {r.id: r.reason for r in rejects.collect()} == {
        1: "missing", 2: "wrong length", 3: "all zero", 4: "not finite", 5: "not finite", 7: "not finite"
    }


def test_ids(spark):
    df = spark.createDataFrame([(9, "a"), (None, "b"), (None, "c"), (3, "d")], "id long, x string").repartition(3)
    got = {r.x: r.id for r in assign_ids(df).collect()}
    assert got["a"] == 9 and got["d"] == 3 and sorted([got["b"], got["c"]]) == [10, 11]
    assert sorted(r.id for r in assign_ids(spark.range(1000).selectExpr("id AS x").repartition(7), above=5).collect()) == list(range(6, 1006))
    ordered = assign_ids(spark.range(1000).selectExpr("id AS x").repartition(7), "x")
    assert ordered.where("id <> x + 1").count() == 0


def test_lookup_with_a_hot_key(spark):
    """A key that holds a third of all rows goes by broadcast, the rest by shuffle."""
    facts = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 100) END AS k")
    keyed = facts.select("k").distinct().withColumn("v", F.length("k"))
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    joined = keyed_lookup(facts, keyed, "k", counts, hot_keys=10, broadcast_facts=0)
    assert joined.count() == 3000 and joined.where("v <> length(k)").count() == 0
    assert joined.select("id").distinct().count() == 3000


def test_shuffle_partitions_follow_the_input(spark):
    from shelfmark.session import setting, tune_shuffle

    with setting(spark, "spark.sql.shuffle.partitions", "4"):
        assert tune_shuffle(spark, 1 << 20) == spark.sparkContext.defaultParallelism
        assert tune_shuffle(spark, 100 << 40) == 200_000


def test_large_vocabulary_needs_no_key(spark):
    df = corpus(spark).withColumn("id", F.when(F.col("id") > 1, F.col("id")))  # null keys too
    embedder = HashEmbedder.fit(df, dim=16)
    near = embedder.transform(df).collect()
    far = embedder.transform(df, broadcast_terms=0, broadcast_facts=0).collect()
    shape = lambda rows: sorted((r.content or "", [round(x, 5) for x in r.embedding or []]) for r in rows)
    assert shape(near) == shape(far) and near[0].asDict().keys() == far[0].asDict().keys()


def test_only_rare_terms_of_a_large_vocabulary_are_joined(spark, monkeypatch):
    """All terms went through the shuffle where the vocabulary did not fit the broadcast as a whole."""
    texts = [(i, f"common word{i % 3} rare{i} " * (1 + i % 2)) for i in range(40)] + [(90, None), (91, ""), (92, "common")]
    docs = spark.createDataFrame(texts, "id long, text string")
    embedder = HashEmbedder.fit(docs, "text", 64)
    asked = spark.createDataFrame([(100, "rare7 rare7 unseen common"), (101, "unseen"), (102, None)], "id long, text string")
    monkeypatch.setattr(HashEmbedder, "_transform_by_join", None)
    for rows in (docs, docs.unionByName(asked)):
        plain = {r.id: r.embedding for r in embedder.transform(rows, "text").collect()}
        for options in ({"broadcast_facts": 0}, {}):
            got = {r.id: r.embedding for r in embedder.transform(rows, "text", broadcast_terms=4, **options).collect()}
            assert set(got) == set(plain)
            for key, vector in plain.items():
                assert (got[key] is None) == (vector is None)
                assert vector is None or got[key] == pytest.approx(vector, abs=1e-6)
