"""Connected components by alternating star contraction, entirely as joins and aggregates.

Each round lets every node hand its larger neighbours (large star), then its smaller ones
(small star), to the least node it knows. The edge set shrinks to one star per component;
no node's neighbourhood is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import stage

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node of an edge between two different nodes, but the roots.

    ``root`` is the least node reachable; a root has no row of its own. Self-loops and edges with a null end are ignored,
    so an empty or loop-only edge table gives no rows.
    """
    current = stage(
        edges.where(f"{a} <> {b}")
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "edges",
    )
    mark = _mark(current)
    for _ in range(MAX_ROUNDS):
        current = stage(_small_star(_large_star(current)), "edges")
        now = _mark(current)
        if now == mark:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        mark = now
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")


def _mark(edges: DataFrame) -> tuple:
    """A count and an order-free checksum: the same before and after a round without change."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = (
        edges.join(least, "hi")
        .where("lo <> m")
        .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    )
    return moved.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()
