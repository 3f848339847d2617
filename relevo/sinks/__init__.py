"""Sinks: ``csv`` (multi-part, ordered or single-part CSV output and printable result lines)."""
