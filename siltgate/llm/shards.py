"""Contiguous balanced shards by prefix sums of byte sizes.

Documents are put in order (a hash of the text, so that equal texts are neighbours), each
partition of the order is totalled, and the totals of the partitions before give every document
the number of bytes ahead of it. Cutting that number at equal targets gives shards whose sizes
differ by one document at most. No task sees more than its own partition and the totals, one row
per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.llm.common import stage

SHARDS = 40
ROW_BYTES = 16  # what a document takes beside its text
PART_ROWS = 4_000  # rows of a partition of the order, give or take


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """All rows of ``docs`` as doc_id, size, text_crc32, shard, slot (gapless from 0 in its shard).

    The size is the text's UTF-8 bytes plus 16; a null text has no bytes, like an empty one. The
    law is ``bytes``: every shard gets an equal share, give or take one document. Equal texts lie
    together, so a group of copies is parted only where a boundary falls in it; a group larger
    than a shard spans several. Rows that agree in everything are told apart by their place in
    the input. With fewer documents than shards some shards stay empty; an empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    held = stage(sized, "sizes")
    whole = held.agg(F.count("*"), F.sum("size")).first()  # two numbers
    count, total = whole[0], whole[1] or 1
    parts = max(1, -(-count // part_rows))
    order = ["_text", "doc_id", "_row"]
    dealt = stage(
        held.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ordered"
    )
    totals = dealt.groupBy("_part").agg(F.sum("size").alias("_all"))
    ahead = totals.select("_part", (F.sum("_all").over(Window.orderBy("_part")) - F.col("_all")).alias("_ahead"))
    inside = Window.partitionBy("_part").orderBy(*order)
    # One row per partition of the order.
    placed = dealt.join(F.broadcast(ahead), "_part").withColumn(
        "_before", F.col("_ahead") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    )
    # The middle of a document decides, so shards are off by half a document at either end.
    at = F.expr(f"cast((_before * 2 + size) * cast({shards} as decimal(10)) div {2 * total} as int)")
    cut = placed.withColumn("shard", F.least(F.lit(shards - 1), at))
    cut = cut.withColumn("_index", F.row_number().over(inside) - 1)
    # Where each shard begins: its first partition and the row there.
    begins = cut.groupBy("_part", "shard").agg(F.count("*").alias("_n"))
    earlier = begins.select(
        "_part",
        "shard",
        (F.sum("_n").over(Window.partitionBy("shard").orderBy("_part")) - F.col("_n")).alias("_earlier"),
        (F.sum("_n").over(Window.partitionBy("_part").orderBy("shard")) - F.col("_n")).alias("_skipped"),
    )
    # At most one row per partition and one more per shard.
    return cut.join(F.broadcast(earlier), ["_part", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("_earlier") + F.col("_index") - F.col("_skipped")).cast("bigint").alias("slot"),
    )

