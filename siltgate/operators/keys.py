"""New whole-number keys after the largest one in use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions.text import name
from siltgate.session import stage

# monotonically_increasing_id keeps the row's index inside its partition in these bits.
ROW_BITS = 33


def next_key(existing: DataFrame, key: str) -> DataFrame:
    """``next_key``: largest + 1, or 1 when there is none."""
    return existing.agg((F.coalesce(F.max(name(key)), F.lit(0)) + 1).cast("bigint").alias("next_key"))


def assign_keys(batch: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """Number the rows of ``batch`` in ``order``, from the next key on.

    The sorted rows are staged with their partition and place; then a row's key
    is its place plus the rows of earlier partitions. No window covers all rows:
    only the per-partition counts (one row per partition) go through one.
    """
    sorted_rows = stage(
        batch.orderBy(name(order)).withColumn("_place", F.monotonically_increasing_id()), "keys"
    )
    placed = sorted_rows.withColumns(
        {
            "_part": F.shiftright("_place", ROW_BITS),
            "_index": F.col("_place").bitwiseAND((1 << ROW_BITS) - 1),
        }
    ).drop("_place")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    offsets = counts.selectExpr(
        "_part", "coalesce(sum(_rows) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _offset"
    )
    # A single row, read on the driver like any run setting.
    first = next_key(existing, key).first()["next_key"]
    return (
        # At most one row per partition of the sort.
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(key, F.lit(first) + F.col("_offset") + F.col("_index"))
        .drop("_part", "_index", "_offset")
    )
