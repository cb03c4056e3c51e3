"""Retrieval preparation and batch retrieval as DataFrame and streaming jobs."""

from shelfmark.functions.text import clean_lines, html_to_text
from shelfmark.operators.ann import build_ann, search_ann
from shelfmark.operators.pq import build_pq, search_pq
from shelfmark.operators.changes import apply_changes, diff_snapshots
from shelfmark.operators.chunk import chunk_text
from shelfmark.operators.corpus import fit_corpus
from shelfmark.operators.embed import HashEmbedder, ModelEmbedder
from shelfmark.operators.evaluate import evaluate, judge_hits
from shelfmark.operators.extract import extract_text, join_pages
from shelfmark.operators.ids import assign_ids
from shelfmark.operators.prompts import build_prompts, to_passages
from shelfmark.operators.rerank import Bm25Scorer, ModelScorer, pair_windows, rerank
from shelfmark.operators.search import similarity_search
from shelfmark.operators.validate import validate_vectors
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
from shelfmark.plans.retrieve import retrieve
from shelfmark.session import arrow_batch_rows, drop_scratch, get_spark, tune_shuffle
from shelfmark.sources.files import scan_files, stream_files
from shelfmark.sources.tables import (
    append_embeddings,
    count_rows,
    create_embedding_table,
    preview,
    read_questions,
    read_table,
    remove_documents,
    replace_table,
    upsert_embeddings,
    use_namespace,
)
from shelfmark.streaming.sync import ingest_stream, sync_stream

__all__ = [name for name in dir() if not name.startswith("_")]
