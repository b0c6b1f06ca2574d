"""Structured Streaming jobs: incremental scoring and month-to-date event rollups."""
