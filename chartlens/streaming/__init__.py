"""Incremental (Structured Streaming) ingest of chart shards."""

from chartlens.streaming.ingest import ingest_chart_shards, stream_chart_shards

__all__ = ["ingest_chart_shards", "stream_chart_shards"]
