"""Structured Streaming ingestion into the day-partitioned stores.

The analysis itself is a batch query; nothing in it is streaming. New purchase
files arrive over time, so the stores (C13, C14) can also be fed incrementally.
"""

from .loader import start_clustered_stream, start_store_stream

__all__ = ["start_clustered_stream", "start_store_stream"]
