"""Composed jobs: the daily ingest, and the test tables in the feed roles."""
