"""Structured Streaming jobs: landing, incremental loads, queues, live counts, archiving."""
