"""Structured Streaming: micro-batch refresh, time-limited deduplication, archiving sources."""
