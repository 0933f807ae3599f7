"""Structured Streaming trigger of the daily ingest (file arrival)."""

from meterlake.streaming.arrivals import arrived_dates, ingest_arrivals

__all__ = ["arrived_dates", "ingest_arrivals"]
