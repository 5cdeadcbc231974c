"""Imports every query module, which fills the registry."""

from workloads import documents, files, loads, pages, products, runs, streams, users  # noqa: F401
