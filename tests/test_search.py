from __future__ import annotations

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from shelfmark.operators.ann import build_ann, search_ann
from shelfmark.operators.pq import build_pq, search_pq
from shelfmark.operators.search import similarity_search

DIM = 16
CELLS = {"broadcast_bytes": 1, "cell_bytes": 4 * DIM * 30}


def make_rows(spark, n, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, DIM)).astype(np.float32) * rng.integers(1, 5, size=(n, 1))
    data[: copies] = data[0]
    rows = [(i, [float(x) for x in v], i % 4) for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "id long, embedding array<float>, grp int").repartition(3)


def as_queries(df):
    return df.select(F.col("id").alias("query_id"), F.col("embedding").alias("qv"), "grp")


def brute(index, queries, k, metric, allowed=None):
    a, b = queries.astype(float), index.astype(float)
    if metric == "l2":
        s = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1))
    else:
        s = a @ b.T
        if metric == "cosine":
            s = s / np.linalg.norm(a, axis=1)[:, None] / np.linalg.norm(b, axis=1)[None, :]
    s = np.round(s, 6)
    out = {}
    for q in range(len(a)):
        ids = [i for i in range(len(b)) if allowed is None or allowed(q, i)]
        out[q] = sorted(ids, key=lambda i: (s[q, i] if metric == "l2" else -s[q, i], i))[:k]
    return out


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.id)
    return out


@pytest.mark.parametrize("options", [{}, CELLS])
@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_exact(spark, metric, options):
    """A third of the index are copies of one row; ties go by id."""
    data, index = make_rows(spark, 150, copies=50)
    assert found(similarity_search(index, as_queries(index), 4, metric, **options)) == brute(data, data, 4, metric)


@pytest.mark.parametrize("options", [{}, CELLS])
def test_filters(spark, options):
    data, index = make_rows(spark, 120)
    queries = as_queries(index)
    hits = similarity_search(index, queries, 5, "cosine", where="grp = 1", columns=["grp"], **options)
    assert found(hits) == brute(data, data, 5, "cosine", lambda q, i: i % 4 == 1)
    assert hits.where("grp <> 1").count() == 0
    probes = queries.select("query_id", F.explode(F.array("grp", F.lit(0))).alias("block"))
    hits = similarity_search(index, queries, 5, "l2", block_col="grp", probes=probes, **options)
    assert found(hits) == brute(data, data, 5, "l2", lambda q, i: i % 4 in (q % 4, 0))


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 1, "cell_bytes": 8}])
def test_odd_vectors_never_match(spark, options):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [1.0, None]), (7, [1.0, 0.0])]
    index = spark.createDataFrame(rows, "id long, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "query_id long, qv array<float>")
    for metric in ("cosine", "dot", "l2"):
        assert found(similarity_search(index, queries, 10, metric, **options)) == {1: [1, 7]}
    assert similarity_search(index, queries, 10, where="id > 100", **options).count() == 0
    assert similarity_search(index, queries.where("query_id > 5"), 10, **options).count() == 0


def test_refusals(spark):
    _, index = make_rows(spark, 5)
    with pytest.raises(ValueError):
        similarity_search(index, as_queries(index), metric="hamming")
    with pytest.raises(ValueError):
        similarity_search(index, as_queries(index), k=0)
    with pytest.raises(ValueError):
        similarity_search(index, as_queries(index), block_col="grp")


def test_plan(spark, folder):
    path = folder("vectors")
    _, index = make_rows(spark, 40)
    index.write.parquet(path)
    hits = similarity_search(spark.read.parquet(path), as_queries(index), 3, where="grp = 1")
    plan = plan_of(hits)
    assert "EqualTo(grp,1)" in plan and "WindowGroupLimit" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Only the hits are shuffled: the one exchange lies above the scoring.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Exchange hash") < plan.index("MapInArrow")


def test_approximate(spark):
    data, index = make_rows(spark, 600, seed=3)
    queries = as_queries(index)
    ann = build_ann(index, DIM, n_lists=8)
    exact = brute(data, data, 5, "cosine")
    assert found(search_ann(ann, queries, 5, nprobe=8)) == exact
    assert found(search_ann(ann, queries, 5, nprobe=8, **CELLS)) == exact
    some = found(search_ann(ann, queries, 5, nprobe=4))
    recall = np.mean([len(set(some[q]) & set(exact[q])) / 5 for q in exact])
    assert recall > 0.8  # of half the lists; registered searches are held to 0.9 below
    assert ann.rows(spark).count() == 600


def recall(spark, name, sf_dir):
    """Share of the exact best five that a registered query finds."""
    from catalogue.queries import QUERIES

    exact = QUERIES["similarity_topk_cosine"](spark, sf_dir).select("query_id", "id")
    hits = QUERIES[name](spark, sf_dir).select("query_id", "id")
    return exact.join(hits, ["query_id", "id"]).count() / exact.count()


@pytest.mark.parametrize("name", ["similarity_ann", "similarity_pq_trained"])
def test_recall_on_the_given_vectors(spark, name):
    assert recall(spark, name, "/root/testdata/sf0.1") >= 0.9


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_quantised_lists(spark, metric):
    data, index = make_rows(spark, 400, seed=5)
    queries = as_queries(index)
    pq = build_pq(index, DIM, n_sub=3, metric=metric, n_lists=5)
    codes = pq.codes(spark).collect()
    assert len(codes) == 400 and {len(r.code) for r in codes} == {3}
    exact = brute(data, data, 4, metric)
    assert found(search_pq(pq, queries, 4, nprobe=5, shortlist=400)) == exact
    some = found(search_pq(pq, queries, 4, nprobe=5, shortlist=60))
    assert np.mean([len(set(some[q]) & set(exact[q])) / 4 for q in exact]) >= 0.9
    # However lists and questions are cut, the answer is the same.
    assert found(search_pq(pq, queries, 4, nprobe=3, shortlist=20, cell_rows=7, cell_queries=50)) == found(search_pq(pq, queries, 4, nprobe=3, shortlist=20))


def test_quantised_lists_of_few_or_odd_rows(spark):
    rows = [(1, [1.0, 0.0, 2.0]), (2, [1.0, 0.0, 2.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [float("nan"), 1.0, 1.0]), (6, [1.0]), (7, [-1.0, 3.0, 0.5])]
    index = spark.createDataFrame(rows, "id long, embedding array<float>")
    queries = index.select(F.col("id").alias("query_id"), F.col("embedding").alias("qv"))
    pq = build_pq(index, 3, n_sub=2, n_lists=2)
    hits = search_pq(pq, queries, 2, nprobe=2)
    assert sorted((r.query_id, r["rank"], r.id) for r in hits.collect()) == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2), (7, 1, 7), (7, 2, 1)]
    with pytest.raises(ValueError, match="n_sub"):
        build_pq(index, 3, n_sub=4)
    with pytest.raises(ValueError, match="words"):
        build_pq(index, 3, n_sub=2, n_lists=2, codebooks=spark.createDataFrame([(0, 0, [0.0, 0.0])], "sub int, code int, word array<double>"))


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<float>")


@pytest.mark.parametrize("options", [{}, CELLS | {"cell_bytes": 64}])
@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_very_small_and_very_large_components(spark, metric, options):
    data = np.array([[3e-25, 1e-25], [1, 1], [3e25, 1e25], [1, 0], [-2e25, 5e24], [1e-30, 3e-30]], np.float32)
    index = vectors_of(spark, [(i, v.tolist()) for i, v in enumerate(data)])
    queries = index.select(F.col("id").alias("query_id"), F.col("embedding").alias("qv"))
    assert found(similarity_search(index, queries, 3, metric, **options)) == brute(data, data, 3, metric)


@pytest.mark.parametrize("options", [{}, CELLS])
def test_odd_questions_stand_alone(spark, options):
    index = vectors_of(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    asked = spark.createDataFrame([(0, []), (1, [1.0, 0.1]), (2, [1.0, 2.0, 3.0]), (3, None)], "query_id long, qv array<float>")
    assert found(similarity_search(index, asked.coalesce(1), 1, **options)) == {1: [1]}
    assert similarity_search(index, asked.where("query_id IN (0, 3)"), 1, **options).count() == 0
    assert similarity_search(index.limit(0), asked, 1, **options).count() == 0
    with pytest.raises(ValueError, match="length"):
        similarity_search(index, asked.where("query_id = 2"), 1, **options)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_given_centroids(spark, metric, monkeypatch):
    from shelfmark.operators import ann as module

    data, index = make_rows(spark, 80)
    centroids = index.where("id < 7").select(F.col("id").alias("list_id"), F.col("embedding").alias("centroid"))
    nearest = brute(data[:7], data, 1, metric)
    for most in (module.MAX_CENTROID_BYTES, 8 * DIM * 3):  # in one block and in several
        monkeypatch.setattr(module, "MAX_CENTROID_BYTES", most)
        built = build_ann(index, DIM, metric=metric, centroids=centroids)
        assert {r.id: [r.list_id] for r in built.rows(spark).collect()} == nearest
    probed = {q: set(ids) for q, ids in brute(data[:7], data, 2, metric).items()}
    expected = brute(data, data, 3, metric, lambda q, i: nearest[i][0] in probed[q])
    assert found(search_ann(built, as_queries(index), 3, nprobe=2)) == {q: ids for q, ids in expected.items() if ids}


def test_payload_is_read_from_probed_lists_only(spark):
    _, index = make_rows(spark, 60)
    built = build_ann(index, DIM, 6)
    hits = search_ann(built, as_queries(index.where("id = 3")), 2, nprobe=1, columns=["grp"])
    scans = [line for line in plan_of(hits).splitlines() if "grp" in line and "FileScan" in line]
    assert scans and all("PartitionFilters: []" not in line for line in scans)


def test_work_of_a_block_does_not_grow_with_the_queries(monkeypatch):
    """Rows came some at a time for many queries, and the state of all of them was sorted for each."""
    from shelfmark.operators import topk

    rng = np.random.default_rng(4)
    data = rng.normal(size=(5_000, DIM)).astype(np.float32)
    sizes, merge = [], topk.BestRows._merge
    monkeypatch.setattr(topk, "_SLICE_CELLS", 1_000)
    monkeypatch.setattr(topk, "_BLOCK_QUERIES", 100, raising=False)
    monkeypatch.setattr(topk.BestRows, "_merge", lambda self, q, i, s: (sizes.append(len(np.unique(q))), merge(self, q, i, s)))
    for metric in ("cosine", "dot", "l2"):
        best = topk.BestRows(data[:300], metric, 3)
        for at in range(0, 400, 40):
            best.add(np.arange(at, at + 40), data[at : at + 40], np.arange(299, -1, -1) if at == 80 else None)
        got = {}
        for q, i in zip(best.query.tolist(), best.row_id.tolist(), strict=True):
            got.setdefault(q, []).append(i)
        assert got == brute(data[:400], data[:300], 3, metric)
    assert max(sizes) <= 100


def test_many_queries_are_dealt_over_tasks(spark, monkeypatch):
    """One file is one task, and small cells are many copies of a row: tasks follow the products."""
    from shelfmark.operators import search

    data, index = make_rows(spark, 150)
    monkeypatch.setattr(search, "MANY_QUERIES", 100, raising=False)
    monkeypatch.setattr(search, "TASK_PRODUCTS", 150 * 150 * DIM // 8, raising=False)
    hits = similarity_search(index.coalesce(1), as_queries(index), 3)
    assert "RoundRobinPartitioning(8)" in plan_of(hits) and found(hits) == brute(data, data, 3, "cosine")
    monkeypatch.setattr(search, "TASK_PRODUCTS", 1 << 36, raising=False)
    hits = similarity_search(index, as_queries(index), 3, broadcast_bytes=1, cell_bytes=4 * DIM)
    assert f"{search.MAX_COPIES**2}), REPARTITION_BY_NUM" in plan_of(hits) and found(hits) == brute(data, data, 3, "cosine")


def test_cells_of_codes_are_dealt_by_number(spark):
    """Codes are so short that all cells came to a few tasks, however many questions there were."""
    data, index = make_rows(spark, 300)
    pq = build_pq(index, DIM, n_sub=4, n_lists=3)
    hits = search_pq(pq, as_queries(index), 3, nprobe=3, shortlist=300, cell_queries=20)
    lists = pq.codes(spark).select("list_id").distinct().count()
    assert f"{lists * 15}), REPARTITION_BY_NUM" in plan_of(hits) and found(hits) == brute(data, data, 3, "cosine")


def test_codebooks_are_trained_on_all_rows(spark, folder, monkeypatch):
    """About 200,000 rows were taken by default: a single word is the mean of all rows only if all are."""
    from shelfmark.operators import pq as module

    path = folder("many-vectors")
    odd = F.pmod(F.xxhash64("id"), F.lit(1009)).cast("float")
    spark.range(0, 210_000, 1, 4).select("id", F.array(odd, (odd * odd).cast("float")).alias("embedding")).where("embedding[0] > 0").write.parquet(path)
    index = spark.read.parquet(path)
    centroids = spark.createDataFrame([(0, [1.0, 2.0])], "list_id long, centroid array<float>")
    ann = build_ann(index, 2, metric="l2", centroids=centroids)
    word = module.train_codebooks(ann, spark, 1, n_words=1, rounds=1)[0, 0]
    mean = index.agg(F.avg(F.col("embedding")[0].cast("double")) - 1, F.avg(F.col("embedding")[1].cast("double")) - 2).first()
    assert np.allclose(word, list(mean), rtol=1e-9)
    asked = []
    monkeypatch.setattr(module, "build_ann", lambda *a, training_rows, **o: asked.append(training_rows) or ann)
    monkeypatch.setattr(module, "train_codebooks", lambda *a, training_rows, **o: asked.append(training_rows) or word[None, None])
    module.build_pq(index, 2, 1, "l2")
    assert asked == [None, None]


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_many_wide_questions_pass_over_the_index(spark, metric, monkeypatch):
    """Both sides were copied to all cells: for 69,201 questions of 1,024 numbers many times the input."""
    from shelfmark.operators import search

    data, index = make_rows(spark, 150, copies=50)
    odd = spark.createDataFrame([(900, None, 0), (901, [0.0] * DIM, 0), (902, [1.0], 0)], "query_id long, qv array<float>, grp int")
    asked = as_queries(index).unionByName(odd)
    monkeypatch.setattr(search, "MAX_COPIED", 0, raising=False)
    monkeypatch.setattr(search, "HIT_BYTES", 1, raising=False)
    options = {"broadcast_bytes": 4 * DIM * 40, "cell_bytes": 4 * DIM}
    hits = similarity_search(index, asked, 4, metric, columns=["grp"], **options)
    assert "CoGroup" not in plan_of(similarity_search(index, asked, 4, metric, **options))
    assert found(hits) == brute(data, data, 4, metric) and hits.where("grp <> id % 4").count() == 0
    assert similarity_search(index, asked.where("query_id = 901").union(asked.where("query_id = 901")), 4, metric, broadcast_bytes=1, cell_bytes=4 * DIM).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e20])
def test_short_lists_of_codes(monkeypatch, size):
    """A short list left a task for each list that a question probes; now there is one, the same however blocks are cut."""
    import pyarrow as pa

    from shelfmark.operators import pq as module

    rng = np.random.default_rng(6)
    centers, books = rng.normal(size=(3, 6)) * size, rng.normal(size=(3, 5, 2)) * size
    lists, at, codes = np.array([2, 5, 9]), np.array([2, 5, 9])[rng.integers(0, 3, 90)], rng.integers(0, 5, (90, 3)).astype(np.uint8)
    ids = np.arange(90) // 2 * 2  # ids come twice
    vectors = (rng.normal(size=(12, 6)) * size).astype(np.float32)
    probed = [[2, 5], [9], [5, 5, 9], [2, 5, 9]] * 3  # a list named twice counts twice
    asked = np.arange(12) // 2  # so do questions
    left = pa.table({"query_id": asked, "qv": pa.array(vectors.tolist(), pa.list_(pa.float32())), "lists": pa.array(probed, pa.list_(pa.int64()))})
    right = pa.table({"list_id": at, "id": ids, "code": pa.array([c.tobytes() for c in codes], pa.binary())})
    expected = {}
    for q, names in enumerate(probed):
        for name in names:
            gap = (vectors[q].astype(float) - centers[np.searchsorted(lists, name)]).reshape(3, 2)
            for r in np.flatnonzero(at == name):
                d = np.round(((gap - books[np.arange(3), codes[r]]) ** 2).sum(1).sum(), 6)
                expected.setdefault(int(asked[q]), []).append((d, int(ids[r])))
    for limits in ({}, {"_HELD": 10, "_BLOCK_ROWS": 8, "_CELLS": 64}):
        for name, value in limits.items():
            monkeypatch.setattr(module, name, value)
        for most in (4, 25, 1_000):
            got = module._short_lists(left, right, lists, centers, books, 3, "l2", most).to_pylist()
            for q, pairs in expected.items():
                mine = sorted((r["d"], r["id"]) for r in got if r["query_id"] == q)
                theirs = sorted(pairs)[:most]
                assert np.allclose([d for d, _ in mine], [d for d, _ in theirs], rtol=1e-12) and (size > 1 or [i for _, i in mine] == [i for _, i in theirs])
