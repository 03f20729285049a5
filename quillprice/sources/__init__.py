"""Readers, fixture adapters and sinks."""
