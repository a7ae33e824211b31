"""Readers, raw-line parsers and sinks."""
