"""Readers: crawl segments, table cells, exported files, topics."""
