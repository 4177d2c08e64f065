"""Scans with explicit schemas, and sinks."""
