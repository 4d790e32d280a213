"""Spark-first engine for archives of time-based media metadata."""
