from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.changes import apply_changes, diff_snapshots
from shelfmark.operators.embed import HashEmbedder
from shelfmark.plans.index import (
    create_or_sync_index,
    create_or_sync_text_index,
    delete_from_index,
    drop_index,
    index_exists,
    index_rows,
    upsert_index,
)
from shelfmark.plans.ingest import ingest_changes, ingest_files
from shelfmark.sources.files import scan_files
from shelfmark.sources.tables import append_embeddings, create_embedding_table, remove_documents, upsert_embeddings, use_namespace
from shelfmark.streaming.sync import ingest_stream, sync_stream


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_diff_and_apply(spark):
    shape = "id int, a string, b string"
    old = spark.createDataFrame([(1, "x", "y"), (2, "x", None), (3, "q", "q"), (4, None, "x")], shape)
    new = spark.createDataFrame([(1, "x", "y"), (2, "x", "now"), (4, "x", None), (5, "n", "n")], shape)
    changes = diff_snapshots(old, new, "id")
    assert {r.id: r._change for r in changes.collect()} == {2: "update", 3: "delete", 4: "update", 5: "insert"}
    assert rows(apply_changes(old, changes, "id")) == rows(new)
    assert diff_snapshots(new, new, "id").count() == 0
    with pytest.raises(ValueError):
        diff_snapshots(old, new.drop("b"), "id")


def vectors(spark, items):
    return spark.createDataFrame([(i, f"t{i}", v) for i, v in items], "id long, content string, embedding array<float>")


def test_index_lifecycle(spark, table):
    name, path = table("idx")
    options = {"dim": 2, "n_buckets": 4, "path": path}
    assert not index_exists(spark, name)
    first = vectors(spark, [(i, [1.0, float(i)]) for i in range(20)] + [(50, [0.0, 0.0]), (51, [1.0])])
    assert create_or_sync_index(first, name, **options) == {"insert": 20, "update": 0, "delete": 0}
    assert index_exists(spark, name)
    assert create_or_sync_index(first, name, **options) == {"insert": 0, "update": 0, "delete": 0}
    second = vectors(spark, [(i, [1.0, float(i)]) for i in range(5, 20)] + [(3, [2.0, 2.0]), (30, [1.0, 1.0])])
    assert create_or_sync_index(second, name, **options) == {"insert": 1, "update": 1, "delete": 4}
    assert rows(index_rows(spark, name)) == rows(second)
    # Emptying whole buckets leaves nothing behind.
    assert create_or_sync_index(vectors(spark, [(5, [1.0, 5.0])]), name, **options)["delete"] == 16
    assert [r.id for r in index_rows(spark, name).collect()] == [5]
    assert create_or_sync_index(vectors(spark, []), name, **options)["delete"] == 1
    assert index_rows(spark, name).count() == 0


def test_direct_writes(spark, table):
    name, path = table("direct")
    create_or_sync_index(vectors(spark, [(1, [1.0, 1.0]), (2, [2.0, 1.0])]), name, dim=2, n_buckets=2, path=path)
    assert upsert_index(vectors(spark, [(2, [5.0, 5.0]), (3, [1.0, 3.0]), (4, None)]), name) == {"insert": 1, "update": 1, "delete": 0}
    gone = spark.createDataFrame([(1,), (99,)], "id long")
    assert delete_from_index(gone, name)["delete"] == 1
    assert rows(index_rows(spark, name).select("id", F.col("embedding")[0])) == [(2, 5.0), (3, 1.0)]


def test_text_index_embeds_only_changes(spark, table):
    name, path = table("texts")
    shape = "id long, content string"
    embedder = HashEmbedder(16)
    old = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three"), (4, "?")], shape)
    assert create_or_sync_text_index(old, name, embedder, n_buckets=2, path=path) == {"insert": 3, "update": 0, "delete": 0}
    new = spark.createDataFrame([(1, "one"), (2, "zwei"), (3, "!"), (5, "five")], shape)
    assert create_or_sync_text_index(new, name, embedder, n_buckets=2, path=path) == {"insert": 1, "update": 1, "delete": 1}
    assert rows(index_rows(spark, name).select("id", "content")) == [(1, "one"), (2, "zwei"), (5, "five")]
    with pytest.raises(ValueError):
        create_or_sync_text_index(new, name, HashEmbedder(8), n_buckets=2, path=path)


def chunks(spark, items):
    return spark.createDataFrame(
        [(d, n, t, len(t.split()), [1.0]) for d, n, t in items],
        "pdf_name string, chunk_no int, content string, n_tokens int, embedding array<float>",
    )


def test_embedding_table(spark, table):
    name, path = table("emb")
    assert create_embedding_table(spark, name, n_buckets=2, path=path)
    assert not create_embedding_table(spark, name, n_buckets=2, path=path)
    first = chunks(spark, [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")])
    assert upsert_embeddings(first, name) == {"insert": 3, "update": 0, "delete": 0}
    before = {(r.pdf_name, r.chunk_no): r.id for r in spark.table(name).collect()}
    assert sorted(before.values()) == [1, 2, 3]
    assert upsert_embeddings(first, name) == {"insert": 0, "update": 0, "delete": 0}
    # A shorter document loses its stale chunk; others are left alone; ids stay.
    assert upsert_embeddings(chunks(spark, [("a", 0, "new"), ("c", 0, "w")]), name) == {"insert": 1, "update": 1, "delete": 1}
    after = {(r.pdf_name, r.chunk_no): (r.id, r.content) for r in spark.table(name).collect()}
    assert after == {("a", 0): (before["a", 0], "new"), ("b", 0): (before["b", 0], "z"), ("c", 0): (4, "w")}
    append_embeddings(chunks(spark, [("d", 0, "p"), ("e", 0, "q")]), name)
    assert sorted(r.id for r in spark.table(name).collect())[-2:] == [5, 6]


def write(folder, name, text):
    (folder / name).write_text(text)


def test_ingest_and_file_stream(spark, table, folder, tmp_path):
    write(tmp_path, "a.txt", "First file. It is short.")
    write(tmp_path, "b.txt", "Second file.")
    (tmp_path / "c.txt").write_bytes(b"\xff\xff")
    name, path = table("files")
    embedder = HashEmbedder(8)
    report = ingest_files(scan_files(spark, str(tmp_path)), name, embedder, n_buckets=2, path=path)
    assert report == {"insert": 2, "update": 0, "delete": 0, "rejected": 1}
    assert ingest_files(scan_files(spark, str(tmp_path)), name, embedder, n_buckets=2, path=path)["insert"] == 0
    with pytest.raises(ValueError):
        ingest_files(scan_files(spark, str(tmp_path)), name, HashEmbedder(16), n_buckets=2, path=path)

    other, path = table("streamed")
    checkpoint = folder("checkpoint")
    run = lambda: ingest_stream(spark, str(tmp_path), other, embedder, checkpoint, n_buckets=2, path=path)
    assert run() == 1 and spark.table(other).count() == 2
    assert run() == 0
    write(tmp_path, "d.txt", "Third file.")
    assert run() == 1
    assert rows(spark.table(other).select("id", "content")) == [
        (1, "First file. It is short."), (2, "Second file."), (3, "Third file.")
    ] or spark.table(other).count() == 3


def test_sync_stream(spark, table, folder):
    source, checkpoint = folder("source"), folder("checkpoint")
    name, path = table("synced")
    run = lambda: sync_stream(
        spark, source, "id long, v int, embedding array<float>", name, checkpoint, dim=2, version_col="v", n_buckets=2, path=path
    )
    shape = "id long, v int, embedding array<float>"
    drop = lambda items: spark.createDataFrame(items, shape).write.mode("append").parquet(source)
    drop([(1, 1, [1.0, 1.0]), (2, 1, [1.0, 2.0]), (2, 3, [9.0, 9.0]), (2, 2, [5.0, 5.0])])
    assert run() == 1
    assert rows(index_rows(spark, name).select("id", "v")) == [(1, 1), (2, 3)]
    assert run() == 0
    drop([(1, 4, [7.0, 7.0]), (3, 1, [1.0, 1.0])])
    assert run() == 1
    assert rows(index_rows(spark, name).select("id", "v")) == [(1, 4), (2, 3), (3, 1)]


def test_namespace(spark):
    use_namespace(spark, "spark_catalog", "default")
    assert spark.catalog.currentDatabase() == "default"


def test_bucket_count_follows_the_size():
    from shelfmark.sources.keyed import MIN_BUCKETS, buckets_for

    assert buckets_for(1_000, 4_096) == MIN_BUCKETS
    assert buckets_for(1 << 20, 4_096 * 32) == 128
    assert buckets_for(10**12, 4_096) == -(-4_096 * 10**12 // (1 << 30))


def test_writing_some_buckets_spares_the_others(spark, table):
    name, path = table("spared")
    create_or_sync_index(vectors(spark, [(i, [1.0, float(i)]) for i in range(200)]), name, dim=2, n_buckets=32, path=path)
    assert upsert_index(vectors(spark, [(7, [9.0, 9.0])]), name) == {"insert": 0, "update": 1, "delete": 0}
    assert index_rows(spark, name).count() == 200
    assert index_rows(spark, name).where("embedding[0] = 9").count() == 1


def test_deleted_rows_stay_deleted(spark, table):
    """A bucket is emptied; what is appended to it later comes alone."""
    name, path = table("emptied")
    create_embedding_table(spark, name, n_buckets=4, path=path)
    first = chunks(spark, [(f"d{i}", 0, "x") for i in range(8)])
    upsert_embeddings(first, name)
    gone = first.where("pdf_name < 'd6'").select("pdf_name").distinct()
    assert remove_documents(gone, name) == {"insert": 0, "update": 0, "delete": 6}
    append_embeddings(chunks(spark, [(f"e{i}", 0, "y") for i in range(8)]), name)
    left = {r.pdf_name for r in spark.table(name).collect()}
    assert left == {"d6", "d7", *(f"e{i}" for i in range(8))}
    assert spark.table(name).count() == 10


def test_interrupted_switch_loses_no_row(spark, table, monkeypatch):
    from shelfmark.sources import keyed

    name, path = table("interrupted")
    create_or_sync_index(vectors(spark, [(i, [1.0, float(i)]) for i in range(20)]), name, dim=2, n_buckets=4, path=path)
    with monkeypatch.context() as m:
        m.setattr(keyed, "switch_buckets", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert_index(vectors(spark, [(7, [9.0, 9.0]), (30, [1.0, 1.0])]), name)
    assert index_rows(spark, name).count() == 20
    assert upsert_index(vectors(spark, [(7, [9.0, 9.0]), (30, [1.0, 1.0])]), name) == {"insert": 1, "update": 1, "delete": 0}
    assert index_rows(spark, name).count() == 21


def test_duplicate_keys_are_refused(spark, table):
    name, path = table("twice")
    with pytest.raises(ValueError, match="key"):
        create_or_sync_index(vectors(spark, [(2, [1.0, 1.0]), (2, [2.0, 1.0])]), name, dim=2, n_buckets=2, path=path)
    create_or_sync_index(vectors(spark, [(1, [1.0, 1.0])]), name, dim=2, n_buckets=2, path=path)
    with pytest.raises(ValueError, match="key"):
        upsert_index(vectors(spark, [(2, [1.0, 1.0]), (2, [2.0, 1.0])]), name)
    other, path = table("twice_chunks")
    create_embedding_table(spark, other, n_buckets=2, path=path)
    with pytest.raises(ValueError, match="key"):
        upsert_embeddings(chunks(spark, [("a", 0, "x"), ("a", 0, "y")]), other)


def test_foreign_embedder_is_refused(spark, table):
    name, path = table("foreign")
    rows = vectors(spark, [(1, [1.0, 1.0])])
    create_or_sync_index(rows, name, dim=2, n_buckets=2, path=path, embedder_id="A")
    for bad in ("B", None):
        with pytest.raises(ValueError, match="vectors"):
            create_or_sync_index(rows, name, dim=2, embedder_id=bad)
        with pytest.raises(ValueError, match="vectors"):
            upsert_index(rows, name, bad)
    assert create_or_sync_index(rows, name, dim=2, embedder_id="A") == {"insert": 0, "update": 0, "delete": 0}
    other, path = table("foreign_chunks")
    create_embedding_table(spark, other, "A", n_buckets=2, path=path)
    with pytest.raises(ValueError, match="vectors"):
        append_embeddings(chunks(spark, [("a", 0, "x")]), other)
    with pytest.raises(ValueError, match="vectors"):
        upsert_embeddings(chunks(spark, [("a", 0, "x")]), other, "B")


def test_content_named_id_counts_as_content(spark, table):
    name, path = table("id_column")
    shape = "k long, id long, embedding array<float>"
    rows = lambda x: spark.createDataFrame([(1, x, [1.0, 1.0])], shape)
    create_or_sync_index(rows(1), name, key="k", dim=2, n_buckets=2, path=path)
    assert create_or_sync_index(rows(2), name, key="k", dim=2)["update"] == 1


def test_ingest_follows_its_files(spark, table, folder, tmp_path):
    for n, text in (("a.txt", "First file."), ("b.txt", "Second file."), ("c.txt", "Third file."), ("d.txt", "Fourth file.")):
        write(tmp_path, n, text)
    name, path = table("followed")
    embedder, manifest = HashEmbedder(8), folder("manifest")
    run = lambda: ingest_changes(spark, str(tmp_path), name, embedder, manifest, "*.txt", n_buckets=2, path=path)
    assert run() == {"insert": 4, "update": 0, "delete": 0, "rejected": 0}
    assert run() == {"insert": 0, "update": 0, "delete": 0, "rejected": 0}
    write(tmp_path, "a.txt", "First file, updated.")
    write(tmp_path, "b.txt", "  \n ")
    (tmp_path / "c.txt").write_bytes(b"\xff\xff\xff")
    (tmp_path / "d.txt").unlink()
    write(tmp_path, "e.txt", "Fifth file.")
    assert run() == {"insert": 1, "update": 1, "delete": 3, "rejected": 1}
    assert sorted(r.content for r in spark.table(name).collect()) == ["Fifth file.", "First file, updated."]
    # The batch job: blank and unreadable files lose their chunks, and missing ones too when told so.
    write(tmp_path, "a.txt", "\n")
    assert ingest_files(scan_files(spark, str(tmp_path), "a*"), name, embedder)["delete"] == 1
    (tmp_path / "e.txt").unlink()
    assert ingest_files(scan_files(spark, str(tmp_path), "*.txt"), name, embedder, complete=True)["delete"] == 1
    assert spark.table(name).count() == 0


def test_stream_with_deletes(spark, table, folder):
    source, checkpoint = folder("source"), folder("checkpoint")
    name, path = table("with_deletes")
    shape = "id long, v int, embedding array<float>, _change string"
    drop = lambda items: spark.createDataFrame(items, shape).coalesce(1).write.mode("append").parquet(source)
    run = lambda: sync_stream(spark, source, shape, name, checkpoint, dim=2, version_col="v", n_buckets=2, path=path, files_per_batch=1)
    drop([(1, 1, [1.0, 1.0], "insert"), (2, 1, [1.0, 2.0], None), (3, 1, [1.0, 3.0], "insert"), (3, 2, None, "delete")])
    drop([(1, 2, None, "delete"), (9, 1, None, "delete"), (2, 2, [5.0, 5.0], "update"), (4, 1, [1.0, 1.0], "insert")])
    assert run() == 2
    assert rows(index_rows(spark, name).select("id", "v")) == [(2, 2), (4, 1)]


def test_late_older_versions_change_nothing(spark, table, folder):
    """Every order of the same changes, one a batch, ends in the same index."""
    import itertools

    shape = "id long, v int, embedding array<float>, _change string"
    changes = [
        [(1, 5, [1.0, 5.0], "insert"), (2, 9, None, "delete"), (3, 1, [3.0, 1.0], None)],
        [(1, 3, [1.0, 3.0], "update"), (2, 4, [2.0, 4.0], "insert"), (3, 1, [3.0, 2.0], None), (4, 2, None, "delete")],
        [(2, 1, [2.0, 1.0], "insert"), (3, 0, None, "delete"), (4, 3, [4.0, 3.0], "insert"), (5, None, [5.0, 0.0], None)],
    ]
    results = []
    for n, order in enumerate(itertools.permutations(range(3))):
        if n not in (0, 3, 5):
            continue
        source, checkpoint = folder("source"), folder("checkpoint")
        name, path = table(f"versions_{n}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_versions")
        for i in order:
            spark.createDataFrame(changes[i], shape).coalesce(1).write.mode("append").parquet(source)
            assert sync_stream(spark, source, shape, name, checkpoint, dim=2, version_col="v", n_buckets=2, path=path) == 1
        results.append(rows(index_rows(spark, name)))
        drop_index(spark, name)
        assert not spark.catalog.tableExists(f"{name}_versions")
    assert results[0] == results[1] == results[2]
    assert [(r[0], r[1]) for r in results[0]] == [(1, 5), (3, 1), (4, 3), (5, None)]


def test_versions_begin_with_those_of_the_index(spark, table, folder):
    source, checkpoint = folder("source"), folder("checkpoint")
    name, path = table("seeded")
    shape = "id long, v int, embedding array<float>"
    create_or_sync_index(spark.createDataFrame([(1, 7, [1.0, 7.0])], shape), name, dim=2, n_buckets=2, path=path)
    late = [(1, 6, [1.0, 6.0]), (2, 1, [2.0, 1.0])]
    spark.createDataFrame(late, shape).write.parquet(source)
    sync_stream(spark, source, shape, name, checkpoint, dim=2, version_col="v")
    assert rows(index_rows(spark, name).select("id", "v")) == [(1, 7), (2, 1)]
    drop_index(spark, name)


def test_invalid_vector_takes_its_key_out(spark, table):
    name, path = table("invalidated")
    create_or_sync_index(vectors(spark, [(i, [1.0, float(i)]) for i in range(4)]), name, dim=2, n_buckets=2, path=path)
    done = upsert_index(vectors(spark, [(1, [0.0, 0.0]), (2, [5.0, 5.0]), (9, None)]), name)
    assert done == {"insert": 0, "update": 1, "delete": 1}
    assert [r[0] for r in rows(index_rows(spark, name).select("id"))] == [0, 2, 3]
    # Keys of another integer type find their buckets, and no keys change nothing.
    assert delete_from_index(spark.createDataFrame([(3,), (77,)], "id int"), name)["delete"] == 1
    assert delete_from_index(spark.createDataFrame([], "id int"), name)["delete"] == 0


def test_refused_duplicates_leave_no_index(spark, table):
    name, path = table("refused")
    with pytest.raises(ValueError):
        create_or_sync_index(vectors(spark, [(1, [1.0, 1.0]), (1, [2.0, 1.0])]), name, dim=2, n_buckets=2, path=path)
    assert not index_exists(spark, name)


def test_texts_without_a_vector_are_embedded_once(spark, table, folder):
    log = folder("asked")

    class Counting(HashEmbedder):
        def transform(self, df, *args, **kwargs):
            df.select("id").write.mode("append").parquet(log)
            return super().transform(df, *args, **kwargs)

    name, path = table("once")
    sync = lambda items: create_or_sync_text_index(
        spark.createDataFrame(items, "id long, content string"), name, Counting(8), n_buckets=2, path=path
    )
    asked = lambda: sorted(r.id for r in spark.read.schema("id long").parquet(log).collect())
    texts = [(1, "one two"), (2, ""), (3, None), (4, "four")]
    assert sync(texts) == {"insert": 2, "update": 0, "delete": 0}
    assert sync(texts) == {"insert": 0, "update": 0, "delete": 0}
    assert asked() == [1, 2, 3, 4]
    # One gets a text, one loses it, one that had none goes.
    assert sync([(1, ""), (2, "two now"), (4, "four")]) == {"insert": 1, "update": 0, "delete": 1}
    assert sync([(1, ""), (2, "two now"), (4, "four")]) == {"insert": 0, "update": 0, "delete": 0}
    assert asked() == [1, 1, 2, 2, 3, 4]
    assert [r[0] for r in rows(index_rows(spark, name).select("id"))] == [2, 4]
    assert sync([(1, "back"), (2, "two now"), (4, "four")])["insert"] == 1
    drop_index(spark, name)


def test_many_reads_rewrite_the_table_once(spark, table, folder, tmp_path, monkeypatch):
    import shelfmark.plans.ingest as plan
    import shelfmark.sources.keyed as keyed

    for i in range(6):
        write(tmp_path, f"f{i}.txt", f"Text of file {i}.")
    rewrites = []
    switch = keyed.switch_buckets
    monkeypatch.setattr(plan, "PATHS_PER_READ", 2)
    monkeypatch.setattr(keyed, "switch_buckets", lambda *a: (rewrites.append(a[1]), switch(*a)))
    name, path = table("read_in_parts")
    manifest = folder("manifest")
    run = lambda: ingest_changes(spark, str(tmp_path), name, HashEmbedder(8), manifest, "*.txt", n_buckets=2, path=path)
    assert run()["insert"] == 6
    assert rewrites == [name]
    write(tmp_path, "f0.txt", "Another text.")
    (tmp_path / "f1.txt").unlink()
    assert run() == {"insert": 0, "update": 1, "delete": 1, "rejected": 0}
    assert rewrites == [name] * 2
    assert run() == {"insert": 0, "update": 0, "delete": 0, "rejected": 0}
    assert rewrites == [name] * 2


def test_many_folders_are_listed_by_few_tasks(spark, folder):
    """Each folder was a task of its own."""
    path = folder("many-folders")
    spark.range(80).selectExpr("id", "concat('text ', id) AS text").coalesce(1).write.partitionBy("id").text(path)
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    files = scan_files(spark, path, "part-*")
    tracker = context.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert files.count() == 80 and tasks and max(tasks) <= 4 * context.defaultParallelism


def test_many_small_files_are_read_by_few_tasks(spark, table, folder):
    """Every few files were a task, and each task wrote a file for the next step to read."""
    from catalogue.queries import _document_files
    from shelfmark.session import setting

    path = folder("small-files")
    docs = spark.range(60).selectExpr("concat('d', id) AS doc", "concat('text ', id) AS text")
    _document_files(spark, docs, path)
    name, place = table("small_files")
    context = spark.sparkContext
    with setting(spark, "spark.sql.files.maxPartitionBytes", "8m"):
        context.setJobGroup("small-files", "small files")
        done = ingest_changes(spark, path, name, HashEmbedder(8), folder("manifest"), "part-*", n_buckets=2, path=place)
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    infos = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("small-files") for s in tracker.getJobInfo(j).stageIds]
    assert done["insert"] == 60 and max(i.numTasks for i in infos if i) <= 4 * context.defaultParallelism
    assert spark.table(name).where("content = 'text 7' AND pdf_name LIKE '%/doc=d7/part-%.txt'").count() == 1


def test_document_files_are_those_of_spark(spark, folder):
    """Texts of a document that comes twice, null texts and line ends are as Spark's writer has them."""
    from catalogue.queries import _document_files

    rows_in = [("d1", "a\nb"), ("d2", None), ("d3", "x"), ("d3", "x"), (None, "n"), ("d4", "")]
    docs = spark.createDataFrame(rows_in, "doc string, text string").coalesce(1)
    ours, theirs = folder("ours"), folder("theirs")
    docs.write.partitionBy("doc").option("lineSep", "\n").text(theirs)
    _document_files(spark, docs.where("doc = 'd3'").selectExpr("'d9' AS doc", "text"), ours)
    _document_files(spark, docs, ours)
    read = lambda path: sorted((r.path.split("/")[-2], bytes(r.content)) for r in scan_files(spark, path, "part-*").collect())
    assert read(ours) == read(theirs) and len(read(ours)) == 5
    _document_files(spark, docs.limit(0), ours)
    assert scan_files(spark, ours, "part-*").count() == 0
