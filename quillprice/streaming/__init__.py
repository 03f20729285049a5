"""Micro-batch (Structured Streaming) variants of the incremental pipelines."""
