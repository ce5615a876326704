"""Incremental processing of append-only run logs."""
