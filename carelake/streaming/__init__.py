"""Incremental (Structured Streaming) form of the raw-claims load.

The table builds are batch jobs over complete deliveries; only the load step has a
natural incremental form (new delivery files arriving in a folder).
"""

from carelake.streaming.compact import read_batches, stream_load_merged
from carelake.streaming.load import await_loaded, delivery_stream, stream_load

__all__ = ["await_loaded", "delivery_stream", "read_batches", "stream_load", "stream_load_merged"]
