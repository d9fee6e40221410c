"""Incremental landing with Structured Streaming (availableNow + foreachBatch)."""
