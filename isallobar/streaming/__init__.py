"""Structured Streaming forms of the cycle: buckets, progressive publishing, stateful tracking."""
