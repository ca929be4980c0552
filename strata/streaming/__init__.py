"""Structured Streaming form of the landing → Bronze ingest (incremental, exactly once)."""

from strata.streaming.landing import (read_landing_stream, run_bronze_stream,
                                      start_bronze_stream)

__all__ = ["read_landing_stream", "run_bronze_stream", "start_bronze_stream"]
