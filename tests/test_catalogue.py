"""Registered queries against their SQL; ``check.py`` runs all of them."""

from __future__ import annotations

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from check import TABLES, rows_of

QUICK = [
    "chunk_window", "chunk_sentence", "extract_html", "extract_pages", "join_pages", "project_rename", "clean_lines",
    "assign_ids", "corpus_terms", "embed_hash", "embed_plain", "embed_batched", "similarity_topk_cosine",
    "similarity_access", "pair_windows", "retrieve_two_stage", "diff_snapshots", "apply_changes", "create_or_sync_index",
]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query(spark, db, name):
    ours = entry.queries()[name](spark, str(TESTDATA)).toPandas()
    theirs = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
