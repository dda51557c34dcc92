"""Sinks: files, lines, topics, keyed upserts, transactional and write-ahead output."""
