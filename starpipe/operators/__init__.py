"""Extraction, dimensions, facts, audits, analyses and sinks."""
