"""Structured Streaming jobs: topic ingest, topic publish, index publish."""
