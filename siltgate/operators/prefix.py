"""Running totals over long sequences without one task per group.

A window over a whole group would put a hot group on one task. Here positions
are cut into chunks of bounded length: totals per chunk, a running total over
the chunks, and windows inside each chunk only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.functions.text import name

CHUNK = 4096


def running_total_before(
    df: DataFrame, group: list[str], position: str, value: str, result: str, chunk: int = CHUNK
) -> DataFrame:
    """Add ``result``: the sum of ``value`` over earlier positions of the group.

    ``position`` is a non-negative whole number, unique in its group.
    """
    cut = df.withColumn("_chunk", F.expr(f"{name(position)} div {chunk}"))
    totals = cut.groupBy(*group, "_chunk").agg(F.sum(value).alias("_chunk_total"))
    over_chunks = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "_chunk", F.coalesce(F.sum("_chunk_total").over(over_chunks), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy(*group, "_chunk").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = cut.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(offsets, [*group, "_chunk"])
        .withColumn(result, F.col("_offset") + F.col("_local"))
        .drop("_chunk", "_offset", "_local")
    )
