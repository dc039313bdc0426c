"""Sinks: CSV/JSON/text writers and the snapshot lifecycle."""
