"""Scans, document parsers, feeds and sinks."""
