"""Triggered streams that keep tables and indexes in step with new files."""
