"""Each query runs library operators over whole tables of the given directory."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.common import unnest
from shelfmark.functions.text import clean_lines
from shelfmark.functions.vectors import to_cells
from shelfmark.operators.ann import build_ann, search_ann
from shelfmark.operators.pq import build_pq, search_pq
from shelfmark.operators.changes import apply_changes, diff_snapshots
from shelfmark.operators.chunk import chunk_text
from shelfmark.operators.corpus import CorpusStats, fit_corpus
from shelfmark.operators.embed import HashEmbedder, ModelEmbedder
from shelfmark.operators.evaluate import evaluate
from shelfmark.operators.extract import extract_text, join_pages
from shelfmark.operators.ids import assign_ids
from shelfmark.operators.prompts import build_prompts, to_passages
from shelfmark.operators.rerank import Bm25Scorer, ModelScorer, pair_windows, rerank
from shelfmark.operators.search import similarity_search
from shelfmark.operators.validate import validate_vectors
from shelfmark.plans.index import create_or_sync_index, create_or_sync_text_index, delete_from_index, index_rows, upsert_index
from shelfmark.plans.ingest import ingest_changes, ingest_files
from shelfmark.plans.retrieve import retrieve
from shelfmark.session import free_shuffles, materialize, scratch_path, setting, spread
from shelfmark.sources.files import scan_files
from shelfmark.sources.tables import (
    append_embeddings,
    count_rows,
    create_embedding_table,
    read_questions,
    read_table,
    replace_table,
    upsert_embeddings,
    use_namespace,
)
from shelfmark.streaming.sync import ingest_stream, sync_stream

DIM = 1024
SMALL_DIM = 256


# ---------------------------------------------------------------- inputs


def _documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/documents.parquet").select(*(columns or ("doc_id", "text")))
    return spread(table, "doc_id")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The given vectors all have unit length: rescale, so that the metrics differ."""
    scaled = F.transform("embedding", lambda x: (x * (1 + F.col("vec_id") % 7)).cast("float"))
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), scaled.alias("embedding"), "label")


def _vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf).select(F.col("id").alias("query_id"), F.col("embedding").alias("qv"), "label")


def _benchmark_questions(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def _chat_questions(spark: SparkSession, sf: str) -> DataFrame:
    turns = _table(spark, sf, "conversations").where("role = 'user'")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("question"))


def _chunk_index(spark: SparkSession, sf: str) -> tuple[DataFrame, HashEmbedder]:
    """Chunks with ids, pdf_name, content and fitted vectors, each computed once."""
    # Sorting the documents rather than the chunks: chunking keeps the order, and the
    # range partitioner does not run it a second time to sample it.
    docs = _documents(spark, sf).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    # Texts are stored twice, with their places and with their vectors, and compressed well.
    with setting(spark, "spark.sql.parquet.compression.codec", "zstd"):
        numbered = assign_ids(chunk_text(docs, "doc_id"))
        chunks = numbered.select("id", F.concat(F.lit("doc-"), "doc_id").alias("pdf_name"), "content")
        embedder = HashEmbedder.fit(chunks, "content", DIM)
        index = materialize(embedder.transform(chunks, key="id"), "index")
    free_shuffles(spark)
    return index, embedder


def _document_index(spark: SparkSession, sf: str) -> tuple[DataFrame, HashEmbedder]:
    docs = _documents(spark, sf).select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    embedder = HashEmbedder.fit(docs, "content", SMALL_DIM)
    return materialize(embedder.transform(docs, key="id"), "index"), embedder


def _fresh_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name that is free, and a path for its files on the shared folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return name, scratch_path(spark, name)


def _long(df: DataFrame, key: str, digits: int = 5) -> DataFrame:
    """Vectors as rows of non-zero cells."""
    cells = unnest(df.select(key, to_cells(F.col("embedding")).alias("c")), [key], "c")
    cells = cells.select(key, F.col("slot").cast("bigint").alias("slot"), F.round("v", digits).alias("value"))
    return cells.where(F.abs("value") > 0.5 * 10.0**-digits)


def _ranked(hits: DataFrame, *columns: str) -> DataFrame:
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", "score", *columns)


# ---------------------------------------------------------------- text


def _chunks_out(chunks: DataFrame, key: str) -> DataFrame:
    return chunks.select(
        key, F.col("chunk_no").cast("bigint").alias("chunk_no"), "content", F.col("n_tokens").cast("bigint").alias("n_tokens")
    )


def chunk_window(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks_out(chunk_text(_documents(spark, sf), "doc_id", mode="window"), "doc_id")


def chunk_sentence(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks_out(chunk_text(_documents(spark, sf), "doc_id", mode="sentence"), "doc_id")


def extract_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select(
        "page_id", F.col("url").alias("path"), F.col("html").cast("binary").alias("content")
    )
    return extract_text(spread(pages, "page_id"), "html").select("page_id", "text")


def extract_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A user's extractor: form feeds would part pages, here blank-line blocks do; one kind of file fails."""

    def make():
        def pages(content: bytes) -> list[str]:
            if content.startswith(b"That"):
                raise ValueError("unreadable")
            return content.decode("utf-8").split("\n")

        return pages

    files = _documents(spark, sf).select(
        "doc_id", F.concat(F.lit("doc-"), "doc_id").alias("path"), F.col("text").cast("binary").alias("content")
    )
    return extract_text(files, make).select("doc_id", "text", "error")


def join_turns(spark: SparkSession, sf: str) -> DataFrame:
    return join_pages(_table(spark, sf, "conversations"), "conv_id", "turn", "text", "text")


def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").withColumn("n_chars", F.length("text").cast("bigint"))
    return docs.select(F.concat_ws("/", "source", F.col("doc_id")).alias("pdf_name"), F.col("text").alias("content"), "n_chars")


def clean_document_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select("doc_id", clean_lines(F.col("text")).alias("text"))


def assign_document_ids(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(F.col("lang") == "de", F.col("doc_id") + 1_000_000)
    docs = _table(spark, sf, "documents").select("doc_id", given.alias("id"))
    return assign_ids(docs, "doc_id").select("doc_id", "id")


# ---------------------------------------------------------------- vectors


def embed_hash(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    embedder = HashEmbedder.fit(docs, "text", DIM)
    return _long(embedder.transform(docs, "text", key="doc_id"), "doc_id")


def embed_hash_by_join(spark: SparkSession, sf: str) -> DataFrame:
    """The way of a vocabulary too large to broadcast, taken on purpose."""
    docs = _documents(spark, sf)
    embedder = HashEmbedder.fit(docs, "text", SMALL_DIM)
    return _long(embedder.transform(docs, "text", key="doc_id", broadcast_terms=0, hot_keys=200, broadcast_facts=0), "doc_id")


def embed_plain(spark: SparkSession, sf: str) -> DataFrame:
    return _long(HashEmbedder(SMALL_DIM).transform(_documents(spark, sf), "text"), "doc_id")


def embed_batched(spark: SparkSession, sf: str) -> DataFrame:
    def make():
        import numpy as np

        return lambda texts: np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)

    model = ModelEmbedder("lengths", make, 2)
    out = model.transform(_documents(spark, sf), "text")
    cell = lambda i: F.get("embedding", F.lit(i)).cast("bigint")
    return out.select("doc_id", cell(0).alias("n_chars"), cell(1).alias("n_blanks"))


def embed_query_parity(spark: SparkSession, sf: str) -> DataFrame:
    """A text has the same vector as a row of the corpus and as a question."""
    texts = _table(spark, sf, "benchmark")
    embedder = HashEmbedder.fit(texts, "text", SMALL_DIM)
    rows = embedder.transform(texts, "text", key="item_id").select("item_id", "embedding")
    asked = embedder.transform(texts.withColumnRenamed("text", "question"), "question", "qv", key="item_id")
    joined = rows.join(asked, "item_id")
    return joined.select("item_id", F.size("qv").cast("bigint").alias("dim"), (F.col("qv") == F.col("embedding")).alias("same"))


def validate_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Faults made from the label, in every row that has it."""
    e, label = F.col("embedding"), F.col("label")
    broken = (
        F.when(label == 0, F.lit(None))
        .when(label == 1, F.slice(e, 1, 32))
        .when(label == 2, F.transform(e, lambda x: F.lit(0.0).cast("float")))
        .when(label == 3, F.transform(e, lambda x, i: F.when(i == 5, F.lit(float("nan")).cast("float")).otherwise(x)))
        .otherwise(e)
    )
    rows = _table(spark, sf, "embeddings").select("vec_id", broken.alias("embedding"))
    valid, rejects = validate_vectors(rows, 64)
    both = valid.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects)
    return both.select("vec_id", "reason")


# ---------------------------------------------------------------- search


def _topk(metric: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _ranked(similarity_search(_vectors(spark, sf), _vector_queries(spark, sf), 5, metric, columns=["label"]), "label")

    return query


def similarity_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(similarity_search(_vectors(spark, sf), _vector_queries(spark, sf), 5, "l2", where="label = 3"))


def similarity_access(spark: SparkSession, sf: str) -> DataFrame:
    """A caller sees rows of its own label and of the next one."""
    queries = _vector_queries(spark, sf)
    allowed = queries.select("query_id", F.explode(F.array("label", (F.col("label") + 1) % 10)).alias("block"))
    hits = similarity_search(
        _vectors(spark, sf), queries, 5, "cosine", columns=["label"], block_col="label", probes=allowed
    )
    return _ranked(hits, "label")


def similarity_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The way of a query table too large to broadcast, taken on purpose."""
    hits = similarity_search(
        _vectors(spark, sf), _vector_queries(spark, sf), 5, "cosine", columns=["label"],
        broadcast_bytes=1, cell_bytes=64 * 4 * 256,
    )
    return _ranked(hits, "label")


def similarity_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """Very small, plain and very large components side by side, by label."""
    power = F.element_at(F.array(F.lit(1e-25), F.lit(1.0), F.lit(1e25)), (F.col("label") % 3 + 1).cast("int"))
    rows = _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: (x.cast("double") * power).cast("float")).alias("embedding")
    )
    return _ranked(similarity_search(rows, rows.select(F.col("id").alias("query_id"), F.col("embedding").alias("qv")), 5, "cosine"))


def similarity_ann(spark: SparkSession, sf: str) -> DataFrame:
    """The first 16 vectors are the centroids; twelve of their lists are looked through, which
    finds over 0.9 of the exact answer: the given vectors are hardly clustered."""
    rows = _vectors(spark, sf)
    centroids = rows.where("id < 16").select(F.col("id").alias("list_id"), F.col("embedding").alias("centroid"))
    ann = build_ann(rows, 64, metric="cosine", centroids=centroids)
    return _ranked(search_ann(ann, _vector_queries(spark, sf), 5, 12, columns=["label"]), "label")


def similarity_pq(spark: SparkSession, sf: str) -> DataFrame:
    """The first 16 vectors are the centroids, and parts of the next 64 the words of the codes:
    16 bytes a row for vectors of 256."""
    rows = _vectors(spark, sf)
    centroids = rows.where("id < 16").select(F.col("id").alias("list_id"), F.col("embedding").alias("centroid"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = rows.where("id BETWEEN 16 AND 79").select("id", F.transform("embedding", lambda x: x.cast("double") / norm).alias("u"))
    words = unit.select(F.explode(F.sequence(F.lit(0), F.lit(15))).alias("sub"), (F.col("id") - 16).alias("code"), "u")
    words = words.select("sub", "code", F.slice("u", F.col("sub") * 4 + 1, F.lit(4)).alias("word"))
    pq = build_pq(rows, 64, 16, codebooks=words, centroids=centroids)
    return _ranked(search_pq(pq, _vector_queries(spark, sf), 5, 14, 100, ["label"]), "label")


def similarity_pq_trained(spark: SparkSession, sf: str) -> DataFrame:
    """Lists and codes trained on all rows; recall is held against the exact answer in the tests."""
    pq = build_pq(_vectors(spark, sf), 64, 16, n_lists=16)
    return _ranked(search_pq(pq, _vector_queries(spark, sf), 5, 14, 200, ["label"]), "label")


def _ann(nprobe: int, n_lists: int):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        ann = build_ann(_vectors(spark, sf), 64, n_lists, "cosine")
        return _ranked(search_ann(ann, _vector_queries(spark, sf), 5, nprobe, columns=["label"]), "label")

    return query


# ---------------------------------------------------------------- retrieval


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """For each benchmark passage, the document chunks that match best."""
    index, embedder = _chunk_index(spark, sf)
    questions = _benchmark_questions(spark, sf)
    asked = materialize(embedder.transform(questions, "question", "qv", key="query_id"), "questions")
    return _ranked(similarity_search(index, asked, 5, columns=["pdf_name"]), "pdf_name")


def rerank_bm25(spark: SparkSession, sf: str) -> DataFrame:
    index, embedder = _document_index(spark, sf)
    questions = _benchmark_questions(spark, sf)
    asked = materialize(embedder.transform(questions, "question", "qv", key="query_id"), "questions")
    hits = similarity_search(index, asked, 20, columns=["content"])
    ranked = rerank(hits, asked, Bm25Scorer(embedder.stats))
    return ranked.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id", "score",
        F.col("first_rank").cast("bigint").alias("first_rank"),
    )


def rerank_model(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in pair model that counts the question's words in the passage, windowed to 64 tokens."""

    def make():
        import numpy as np

        def score(questions, passages):
            return np.array([len(set(q.split()) & set(p.split())) for q, p in zip(questions, passages)], dtype=float)

        return score

    index, embedder = _document_index(spark, sf)
    questions = _benchmark_questions(spark, sf)
    asked = materialize(embedder.transform(questions, "question", "qv", key="query_id"), "questions")
    hits = similarity_search(index, asked, 5, columns=["content"])
    return _ranked(rerank(hits, asked, ModelScorer(make, max_tokens=128)))


def pair_windows_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document paired with a question made of its language and source."""
    pairs = _documents(spark, sf, "doc_id", "text", "lang", "source").select(
        F.lit(0).cast("bigint").alias("query_id"), F.col("doc_id").alias("id"), F.col("text").alias("content"),
        F.concat_ws(" ", F.lit("about"), "lang", "source").alias("question"),
    )
    out = pair_windows(pairs)
    return out.select("id", F.col("part_no").cast("bigint").alias("part_no"), "part", F.col("n_tokens").cast("bigint").alias("n_tokens"))


def retrieve_two_stage(spark: SparkSession, sf: str) -> DataFrame:
    index, embedder = _chunk_index(spark, sf)
    found = retrieve(index, _benchmark_questions(spark, sf), embedder, Bm25Scorer(embedder.stats))
    return found.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id", "pdf_name", "score"
    )


def passages_flat(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of each vector's nearest rows of label 3, opened again with their position."""
    queries = _vector_queries(spark, sf)
    rows = _vectors(spark, sf).select(
        "id", "embedding", "label", F.concat(F.lit("file-"), "id").alias("pdf_name"),
        F.concat(F.lit("label "), "label").alias("content"),
    )
    hits = similarity_search(rows, queries, 3, "l2", where="label = 3", columns=["pdf_name", "content"])
    flat = to_passages(queries, hits).select("query_id", F.posexplode("passages").alias("pos", "p"))
    return flat.select("query_id", F.col("pos").cast("bigint").alias("pos"), F.col("p.file").alias("file"), F.col("p.text").alias("text"))


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    index, embedder = _chunk_index(spark, sf)
    asked = materialize(embedder.transform(_chat_questions(spark, sf), "question", "qv", key="query_id"), "questions")
    hits = similarity_search(index, asked, 3, columns=["pdf_name", "content"])
    built = build_prompts(asked, to_passages(asked, hits), system="Answer in one sentence, from the context alone.")
    return built.select("query_id", "system", F.md5("prompt").alias("prompt_md5"), "has_context")


def eval_hit_at_k(spark: SparkSession, sf: str) -> DataFrame:
    """The questions come from a CSV set, as they are handed over for an evaluation."""
    index, embedder = _document_index(spark, sf)
    kind = F.when(F.length("question") < 200, "short").otherwise("long")
    asked_for = _benchmark_questions(spark, sf).select(
        "question", F.col("question").alias("ground_truth"), kind.alias("evolution_type"), F.lit(True).alias("episode_done")
    )
    folder = scratch_path(spark, "question-set")
    asked_for.write.option("header", "true").option("escape", '"').option("quoteAll", "true").csv(folder)
    questions = assign_ids(read_questions(spark, folder)).withColumnRenamed("id", "query_id")
    asked = materialize(embedder.transform(questions, "question", "qv", key="query_id"), "questions")
    hits = similarity_search(index, asked, 5, columns=["content"])
    out = evaluate(asked, hits, 5)
    return out.select(
        "evolution_type", "n_questions", F.round("hit_at_k", 6).alias("hit_at_k"), F.round("mrr", 6).alias("mrr"),
        F.round("recall", 6).alias("recall"),
    )


def corpus_terms(spark: SparkSession, sf: str) -> DataFrame:
    stats: CorpusStats = fit_corpus(_documents(spark, sf), "text")
    return stats.terms(spark).select("term", "df", F.round("idf", 6).alias("idf"))


# ---------------------------------------------------------------- tables and syncs


def count_documents(spark: SparkSession, sf: str) -> DataFrame:
    use_namespace(spark, "spark_catalog", "default")
    name, path = _fresh_table(spark, "shelfmark_raw_text")
    replace_table(_documents(spark, sf), name, path)
    return count_rows(read_table(spark, name))


def _benchmark_files(spark: SparkSession, sf: str) -> str:
    folder = scratch_path(spark, "files")
    _table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(folder)
    return folder


def _item_id(path: str) -> Column:
    return F.regexp_extract(path, r"item_id=(\d+)", 1).cast("bigint").alias("item_id")


def scan_benchmark_files(spark: SparkSession, sf: str) -> DataFrame:
    files = scan_files(spark, _benchmark_files(spark, sf), "*.txt")
    return extract_text(files).select(_item_id("path"), "length", "text")


def ingest_benchmark_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files to embedding table, run twice: the second run changes nothing."""
    files = scan_files(spark, _benchmark_files(spark, sf))
    name, path = _fresh_table(spark, "shelfmark_file_vectors")
    embedder = HashEmbedder(SMALL_DIM)
    ingest_files(files, name, embedder, n_buckets=4, path=path)
    ingest_files(files, name, embedder, n_buckets=4, path=path)
    return _chunk_cells(read_table(spark, name))


def _doc_id(pattern: str) -> Column:
    return F.regexp_extract("pdf_name", pattern, 1).cast("bigint").alias("doc_id")


def _chunk_cells(rows: DataFrame, number: Column | None = None, digits: int = 5) -> DataFrame:
    """Every non-zero cell of the vectors of a table of chunks."""
    return _named_cells(_named_chunks(rows, _item_id("pdf_name") if number is None else number), digits)


def _named_chunks(rows: DataFrame, number: Column) -> DataFrame:
    return rows.select(number, F.col("chunk_no").cast("bigint").alias("chunk_no"), F.md5("content").alias("content_md5"), "embedding")


def _named_cells(named: DataFrame, digits: int = 5) -> DataFrame:
    keys = [c for c in named.columns if c != "embedding"]
    cells = unnest(named.select(*keys, to_cells(F.col("embedding")).alias("c")), keys, "c")
    cells = cells.select(*keys[:3], F.col("slot").cast("bigint").alias("slot"), F.round("v", digits).alias("value"), *keys[3:])
    return cells.where(F.abs("value") > 0.5 * 10.0**-digits)


def _document_files(spark: SparkSession, docs: DataFrame, folder: str) -> None:
    """``(doc, text)`` as text files, in a folder for each document, in place of what was there.

    As ``partitionBy("doc").text`` writes them, which takes far longer for so many files of a line or two:
    they are moved twice, the second time by the driver alone. Where Arrow cannot write, Spark does.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    place, run = files.makeQualified(path).toString(), uuid.uuid4().hex
    try:
        pa_fs.FileSystem.from_uri(place)
    except (pa.ArrowException, OSError):
        docs.write.mode("overwrite").partitionBy("doc").option("lineSep", "\n").text(folder)
        return
    files.delete(path, True)
    files.mkdirs(path)

    def write(batches):
        store, root = pa_fs.FileSystem.from_uri(place)
        name = f"part-{TaskContext.get().partitionId():05d}-{run}.c000.txt"
        out = last = None
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None or doc != last:
                    if out is not None:
                        out.close()
                    home, last = f"{root}/doc={'__HIVE_DEFAULT_PARTITION__' if doc is None else doc}", doc
                    store.create_dir(home)
                    out = store.open_output_stream(f"{home}/{name}")
                out.write((text or b"") + b"\n")
        if out is not None:
            out.close()
        yield from ()

    rows = docs.select("doc", F.col("text").cast("binary")).sortWithinPartitions("doc")
    rows.mapInArrow(write, "n int").write.format("noop").mode("overwrite").save()


def ingest_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as files in two versions: French ones are revised, German ones become blank,
    Spanish ones are removed and English ones of odd number are new."""
    docs = _documents(spark, sf, "doc_id", "text", "lang")
    folder = scratch_path(spark, "document-files")
    name, path = _fresh_table(spark, "shelfmark_updated_files")
    manifest, embedder = scratch_path(spark, "manifest"), HashEmbedder(SMALL_DIM)
    first = docs.where("lang <> 'en' OR doc_id % 2 = 0")
    revised = F.when(F.col("lang") == "fr", F.concat(F.lit("Revu. "), "text")).when(F.col("lang") == "de", F.lit(" ")).otherwise(F.col("text"))
    for version in (first, docs.where("lang <> 'es'").withColumn("text", revised)):
        _document_files(spark, version.select(F.concat(F.lit("d"), "doc_id").alias("doc"), "text"), folder)
        ingest_changes(spark, folder, name, embedder, manifest, "part-*", n_buckets=4, path=path)
    return _chunk_cells(read_table(spark, name), _doc_id("/doc=d([0-9]+)/"))


def ingest_file_stream(spark: SparkSession, sf: str) -> DataFrame:
    """New files by triggered stream; the second run finds nothing new."""
    folder = _benchmark_files(spark, sf)
    name, path = _fresh_table(spark, "shelfmark_stream_vectors")
    checkpoint = scratch_path(spark, "checkpoint")
    runs = [
        ingest_stream(spark, folder, name, HashEmbedder(SMALL_DIM), checkpoint, n_buckets=4, path=path)
        for _ in range(2)
    ]
    return _chunk_cells(read_table(spark, name)).withColumn("second_run", F.lit(runs[1]).cast("bigint"))


def _embedded_chunks(docs: DataFrame, embedder: HashEmbedder) -> DataFrame:
    chunks = chunk_text(docs, "doc_id")
    rows = chunks.select(F.concat(F.lit("doc-"), "doc_id").alias("pdf_name"), "chunk_no", "content", "n_tokens")
    return embedder.transform(rows, "content", "embedding", key=["pdf_name", "chunk_no"])


def append_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Plain appends under generated ids: twice the rows, all ids distinct, without gaps."""
    embedder = HashEmbedder(SMALL_DIM)
    rows = materialize(_embedded_chunks(_documents(spark, sf), embedder), "embedded")
    name, path = _fresh_table(spark, "shelfmark_appended")
    create_embedding_table(spark, name, embedder.embedder_id, n_buckets=4, path=path)
    append_embeddings(rows, name, embedder.embedder_id)
    append_embeddings(rows, name, embedder.embedder_id)
    stored = read_table(spark, name)
    ids = stored.agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).first()
    # Counted as whole chunks: the cells of equal chunks are equal, and far more rows.
    named = _named_chunks(stored, _doc_id("^doc-([0-9]+)$"))
    copies = _named_cells(named.groupBy(*named.columns).agg(F.count("*").alias("n_copies")))
    return copies.select("*", *[F.lit(n).cast("bigint").alias(c) for c, n in ids.asDict().items()])


def upsert_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents come back shorter or changed by language: stale chunks go, kept ones keep their id."""
    first = _documents(spark, sf, "doc_id", "text", "lang")
    shorter = F.when(F.col("lang") == "fr", F.concat_ws(" ", F.lit("Neu."), "text")).when(
        F.col("lang") == "de", F.substring_index("text", ".", 2)
    )
    second = first.withColumn("text", F.coalesce(shorter, "text"))
    name, path = _fresh_table(spark, "shelfmark_upserted")
    embedder = HashEmbedder(SMALL_DIM)
    create_embedding_table(spark, name, embedder.embedder_id, n_buckets=8, path=path)
    for version in (first, second):
        upsert_embeddings(_embedded_chunks(version, embedder), name, embedder.embedder_id)
    return _chunk_cells(read_table(spark, name), _doc_id("^doc-([0-9]+)$"))


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Spanish documents are new, German ones gone, French ones changed or emptied."""
    docs = _documents(spark, sf, "doc_id", "text", "lang", "source")
    old = docs.where("lang <> 'es'")
    changed = F.when(F.col("lang") != "fr", F.col("text")).when(F.length("text") > 300, F.concat("text", F.lit(" Revu.")))
    return old, docs.where("lang <> 'de'").withColumn("text", changed)


def diff_documents(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _versions(spark, sf)
    changes = diff_snapshots(old, new, "doc_id")
    return changes.select("doc_id", F.col("_change").alias("change"), F.md5("text").alias("text_md5"), "lang", "source")


def apply_document_changes(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _versions(spark, sf)
    out = apply_changes(old, diff_snapshots(old, new, "doc_id"), "doc_id")
    return out.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


def _index_out(spark: SparkSession, name: str) -> DataFrame:
    """Every cell of every vector of an index."""
    cells = F.transform("embedding", lambda x, i: F.struct(i.cast("bigint").alias("slot"), F.round(x.cast("double"), 6).alias("value")))
    return unnest(index_rows(spark, name).select("id", "label", cells.alias("c")), ["id", "label"], "c")


def sync_index(spark: SparkSession, sf: str) -> DataFrame:
    """Create from one version of the vectors, sync to the next, sync again."""
    final = _vectors(spark, sf)
    label = F.col("label")
    doubled = F.when(label == 3, F.transform("embedding", lambda x: (x * 2).cast("float"))).otherwise(F.col("embedding"))
    name, path = _fresh_table(spark, "shelfmark_index")
    options = {"dim": 64, "n_buckets": 8, "path": path}
    create_or_sync_index(final.where("label <> 9").withColumn("embedding", doubled), name, **options)
    second = create_or_sync_index(final.where("label <> 0"), name, **options)
    third = create_or_sync_index(final.where("label <> 0"), name, **options)
    out = _index_out(spark, name)
    for change in ("insert", "update", "delete"):
        out = out.withColumn(f"n_{change}", F.lit(second[change]).cast("bigint"))
    return out.withColumn("n_third", F.lit(sum(third.values())).cast("bigint"))


def sync_text_index(spark: SparkSession, sf: str) -> DataFrame:
    """A source of texts; the second sync embeds only what changed."""
    old, new = _versions(spark, sf)
    shape = lambda df: df.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    name, path = _fresh_table(spark, "shelfmark_text_index")
    embedder = HashEmbedder(SMALL_DIM)
    create_or_sync_text_index(shape(old), name, embedder, n_buckets=8, path=path)
    create_or_sync_text_index(shape(new), name, embedder, n_buckets=8, path=path)
    return _long(index_rows(spark, name), "id")


def direct_index(spark: SparkSession, sf: str) -> DataFrame:
    """Rows put into an index and deleted from it without a source table."""
    rows = _vectors(spark, sf)
    name, path = _fresh_table(spark, "shelfmark_direct_index")
    create_or_sync_index(rows.where("label < 5"), name, dim=64, n_buckets=8, path=path)
    upsert_index(rows.where("label >= 4").withColumn("label", F.col("label") + 100), name)
    delete_from_index(rows.where("label = 7").select("id"), name)
    return _index_out(spark, name)


def sync_triggered(spark: SparkSession, sf: str) -> DataFrame:
    """Changes arrive in two drops, deletes among them; the third run finds nothing."""
    rows = _vectors(spark, sf)
    folder, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    name, path = _fresh_table(spark, "shelfmark_stream_index")
    put, gone = F.lit("insert").alias("_change"), F.lit("delete").alias("_change")
    later = rows.where("label >= 4").withColumn("label", F.col("label") + 100).select("*", put).unionByName(rows.where("label = 2").select("*", gone))
    schema, runs = later.schema, []
    for drop in (rows.where("label < 6").select("*", put), later, None):
        if drop is not None:
            drop.write.mode("append").parquet(folder)
        runs.append(sync_stream(spark, folder, schema, name, checkpoint, dim=64, n_buckets=8, path=path))
    return _index_out(spark, name).withColumn("third_run", F.lit(runs[2]).cast("bigint"))


def sync_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Versions arrive out of order, one drop a run: older ones come late, also after a delete and
    after a delete that came before any row."""
    rows = _vectors(spark, sf)
    folder, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    name, path = _fresh_table(spark, "shelfmark_versions_index")

    def change(where: str, version: int, kind: str, shift: int = 0) -> DataFrame:
        label = (F.col("label") + shift).cast(rows.schema["label"].dataType)
        return rows.where(where).withColumn("label", label).select("*", F.lit(version).alias("version"), F.lit(kind).alias("_change"))

    drops = (
        change("label < 6", 5, "insert"),
        change("label = 2", 9, "delete").unionByName(change("label = 7", 4, "delete")),
        change("label = 1", 3, "update", 100).unionByName(change("label IN (2, 7)", 3, "insert"))
        .unionByName(change("label = 3", 6, "update", 200)).unionByName(change("label = 8", 1, "insert")),
    )
    for drop in drops:
        drop.write.mode("append").parquet(folder)
        sync_stream(spark, folder, drop.schema, name, checkpoint, dim=64, version_col="version", n_buckets=8, path=path)
    return _index_out(spark, name)


def scan_by_path(spark: SparkSession, sf: str) -> DataFrame:
    """Files picked by a part of their path."""
    files = scan_files(spark, _benchmark_files(spark, sf)).where(F.col("path").rlike("[02468]/[^/]*$"))
    return files.select(_item_id("path"), F.decode("content", "UTF-8").alias("text"))


def embed_with_failures(spark: SparkSession, sf: str) -> DataFrame:
    """A model that refuses some texts; their rows are kept without a vector."""

    def make():
        import numpy as np

        def predict(texts):
            if any(len(t) % 7 == 0 for t in texts):
                raise RuntimeError("refused")
            return np.array([[len(t), t.count(" ")] for t in texts], dtype=np.float32)

        return predict

    out = ModelEmbedder("lengths", make, 2, batch_size=1, on_error="null").transform(_documents(spark, sf), "text")
    return out.select("doc_id", F.coalesce(F.get("embedding", F.lit(0)).cast("bigint"), F.lit(-1)).alias("n_chars"))


QUERIES = {
    "retrieve_flagship": flagship,
    "chunk_window": chunk_window,
    "chunk_sentence": chunk_sentence,
    "extract_html": extract_html,
    "extract_pages": extract_pages,
    "join_pages": join_turns,
    "project_rename": project_rename,
    "clean_lines": clean_document_lines,
    "assign_ids": assign_document_ids,
    "corpus_terms": corpus_terms,
    "embed_hash": embed_hash,
    "embed_hash_by_join": embed_hash_by_join,
    "embed_plain": embed_plain,
    "embed_batched": embed_batched,
    "embed_query_parity": embed_query_parity,
    "validate_vectors": validate_labelled,
    "similarity_topk_cosine": _topk("cosine"),
    "similarity_topk_dot": _topk("dot"),
    "similarity_topk_l2": _topk("l2"),
    "similarity_filtered": similarity_filtered,
    "similarity_access": similarity_access,
    "similarity_cells": similarity_cells,
    "similarity_extremes": similarity_extremes,
    "similarity_ann": similarity_ann,
    "similarity_pq": similarity_pq,
    "similarity_pq_trained": similarity_pq_trained,
    "similarity_ann_all_lists": _ann(8, 8),
    "rerank_bm25": rerank_bm25,
    "rerank_model": rerank_model,
    "pair_windows": pair_windows_documents,
    "retrieve_two_stage": retrieve_two_stage,
    "to_passages": passages_flat,
    "build_prompts": prompts,
    "eval_hit_at_k": eval_hit_at_k,
    "count_rows": count_documents,
    "scan_files": scan_benchmark_files,
    "scan_by_path": scan_by_path,
    "embed_with_failures": embed_with_failures,
    "ingest_updates": ingest_updates,
    "ingest_files": ingest_benchmark_files,
    "ingest_stream": ingest_file_stream,
    "append_embeddings": append_chunks,
    "upsert_embeddings": upsert_chunks,
    "diff_snapshots": diff_documents,
    "apply_changes": apply_document_changes,
    "create_or_sync_index": sync_index,
    "sync_text_index": sync_text_index,
    "direct_index": direct_index,
    "sync_triggered": sync_triggered,
    "sync_versions": sync_versions,
}
