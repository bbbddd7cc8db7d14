"""Scans, parsers and sinks."""
