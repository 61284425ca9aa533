"""Scans, report ingest and sinks."""
