"""Whole runs: one source from records to its table, and all sources together."""
