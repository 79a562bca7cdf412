"""Structured Streaming forms of the operators."""

from wordgraph.streaming.intervals import interval_counts_stream, run_interval_counts

__all__ = ["interval_counts_stream", "run_interval_counts"]
