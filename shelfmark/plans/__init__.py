"""Whole jobs made of operators: ingest, index maintenance, retrieval."""
