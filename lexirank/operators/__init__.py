"""Dataflow operators over label runs."""
