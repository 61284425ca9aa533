"""Spark operators for multi-channel marketing reports."""
