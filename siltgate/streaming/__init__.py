"""Incremental runs over folders that keep filling up."""
