"""The table of queries: name, Spark function and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Runs are stamped with a fixed time so that results compare.
RUN_TS = datetime(2024, 6, 1, 12, 0, 0, tzinfo=timezone.utc)
RUN_TEXT = RUN_TS.isoformat()


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add
