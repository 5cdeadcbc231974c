"""What a source delivers, landed by one pass over it: records and error rows side by side.

A source marks the rows it could not read. All rows go to one staged table in one write, split by
the mark, and are counted as they pass; whether a source failed is then known without another
look at it, and everything after reads the staged rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siltgate.functions.text import name
from siltgate.session import new_path

PART = "silt_part"


@dataclass(frozen=True)
class Delivery:
    records: DataFrame
    errors: DataFrame
    record_count: int
    error_count: int


def deliver(marked: DataFrame, failed: str, label: str) -> Delivery:
    """Stage ``marked``; rows for which the SQL predicate ``failed`` holds are errors.

    The write is the last step of its job, so a task that runs again is counted once.
    """
    spark = marked.sparkSession
    path = new_path(spark, label)
    seen = Observation(f"{label} {uuid.uuid4().hex}")
    split = marked.withColumn(PART, F.when(F.expr(f"coalesce({failed}, false)"), "errors").otherwise("records"))
    split = split.observe(
        seen,
        F.count_if(F.col(PART) == "records").alias("records"),
        F.count_if(F.col(PART) == "errors").alias("errors"),
    )
    split.write.partitionBy(PART).parquet(path)
    counts = {"records": 0, "errors": 0} | {k: v or 0 for k, v in seen.get.items()}

    def part(which: str) -> DataFrame:
        if not counts[which]:
            return spark.createDataFrame([], marked.schema)
        return spark.read.schema(marked.schema).parquet(f"{path}/{PART}={which}").select(*[name(c) for c in marked.columns])

    return Delivery(part("records"), part("errors"), counts["records"], counts["errors"])
