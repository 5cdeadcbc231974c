"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits meet in the variants within r/2 bits of each.
A 64-bit ball of radius 2 has 2,081 variants, some 33 KB of shuffle for every document. So the
fingerprint is first cut into two halves: one of them differs in at most r/2 = 2 bits, and each
half emits its own ball of radius 1 = half of that, 66 variants in all. ``halves=False`` emits
the full ball; both find every pair.

Halves that collide say nothing of the other half, so the members of a bucket are verified bit
by bit, and only a spanning forest of the verified links leaves the task: links grow with the
number of members, not with its square. A bucket of more than ``BUCKET`` fingerprints is split by
the other half, in which its members differ in at most r bits, so one of that half's quarters
differs in at most r/2: it meets in balls over quarters, 34 variants. What is crowded even then
emits the full ball, whose buckets are cliques of at most 2,081 fingerprints, each of which links
to the least one there.

How far halves hold: by chance n random fingerprints put n * 33 / 2^32 of them into a bucket,
which stays within ``BUCKET`` up to some 8 * 10^12, and cost n^2 / 4,000,000 comparisons in all,
6 * 10^14 at 5 * 10^10 documents. Beyond 10^12 the full ball (``halves=False``) costs less.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from xxhash import xxh64_intdigest

from siltgate.llm.common import stage
from siltgate.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET = 65_536
SLICE = 1 << 16  # shingles counted at once, so a text of any length takes bounded memory


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number; 0 for a null text or one without words."""
    words = text.lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxh64_intdigest(joined, SEED)  # the only shingle
    ends = list(accumulate(map(len, words), lambda end, n: end + n + 1, initial=0))
    total = len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, SLICE):
        hashes = [
            xxh64_intdigest(joined[start : stop - 1], SEED)
            for start, stop in zip(ends[at : min(at + SLICE, total)], ends[at + shingle :])
        ]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return run(text.cast("binary"))


def _ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``bits`` bits, as signed longs."""
    masks = [
        sum(1 << i for i in places)
        for size in range(radius + 1)
        for places in combinations(range(bits), size)
    ]
    return np.array(masks, dtype=np.uint64).view(np.int64).tolist()


def _variants(fps: DataFrame, radius: int, halves: bool) -> DataFrame:
    """Rows (part, variant, fp)."""
    if not halves:
        masks = F.array(*map(F.lit, _ball(64, radius // 2)))
        full = F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))
        return fps.select(F.lit(0).alias("part"), F.explode(full).alias("variant"), "fp")
    # One half differs in at most radius // 2 bits, and two balls of half of that (rounded up) meet.
    near = -(-(radius // 2) // 2)
    masks = F.array(*map(F.lit, _ball(32, near)))

    def ball(part: int, half: Column) -> Column:
        return F.transform(masks, lambda m: F.struct(F.lit(part).alias("part"), m.bitwiseXOR(half).alias("variant")))

    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    both = F.concat(ball(0, low), ball(1, high))
    return fps.select(F.explode(both).alias("v"), "fp").select("v.part", "v.variant", "fp")


def spanning_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the members within ``radius`` bits of each other."""
    links, rest = [], members
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            here = front.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            links += [(int(here), int(other)) for other in rest[near]]
            front += list(rest[near])
            rest = rest[~near]
    return links


def _quarters(crowded: DataFrame, radius: int) -> DataFrame:
    """Rows (part, variant, quarter, q_variant, fp): the members of crowded buckets by balls over
    the quarters of the half that their bucket says nothing of."""
    near = -(-(radius // 2) // 2)
    masks = F.array(*map(F.lit, _ball(16, near)))
    other = F.when(F.col("part") == 0, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp")).bitwiseAND(0xFFFFFFFF)

    def ball(quarter: int) -> Column:
        value = F.shiftrightunsigned(other, 16 * quarter).bitwiseAND(0xFFFF)
        return F.transform(masks, lambda m: F.struct(F.lit(quarter).alias("quarter"), m.bitwiseXOR(value).alias("q_variant")))

    split = crowded.select("part", "variant", F.explode(F.concat(ball(0), ball(1))).alias("q"), "fp")
    return split.select("part", "variant", "q.quarter", "q.q_variant", "fp")


def _counted(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Rows whose bucket has others, with its size ``n``."""
    return stage(rows.withColumn("n", F.count("*").over(Window.partitionBy(*keys))).where("n > 1"), label)


def _forests(met: DataFrame, keys: list[str], radius: int, bucket: int) -> DataFrame:
    """Links of a spanning forest of each bucket of at most ``bucket`` members."""

    def forest(batches):
        for batch in batches:
            found = []
            for members in batch.column(0):
                values = members.values.to_numpy(zero_copy_only=False).view(np.uint64)
                if len(values) == 2:
                    a, b = values.tolist()
                    if (a ^ b).bit_count() <= radius:
                        found.append((a, b))
                else:
                    found += spanning_links(values, radius)
            ends = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

    gathered = met.where(F.col("n") <= bucket).groupBy(*keys).agg(F.collect_list("fp").alias("members"))
    return gathered.select("members").mapInArrow(forest, "a bigint, b bigint")


def links(fps: DataFrame, radius: int = RADIUS, halves: bool = True, bucket: int = BUCKET) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints; they connect all that are within ``radius`` bits.

    ``fps`` has distinct fingerprints in column ``fp``.
    """
    keys = ["part", "variant"]
    met = _counted(_variants(fps, radius, halves), keys, "met")
    found = _forests(met, keys, radius, bucket)
    crowded = met.where(F.col("n") > bucket)
    # Two looks at a staged table: a table without crowded buckets is done.
    if crowded.isEmpty():
        return found
    if halves:
        keys = [*keys, "quarter", "q_variant"]
        met = _counted(_quarters(crowded.select("part", "variant", "fp"), radius), keys, "met-quarters")
        found = found.unionAll(_forests(met, keys, radius, bucket))
        crowded = met.where(F.col("n") > bucket)
    heavy = (
        _variants(crowded.select("fp").distinct(), radius, halves=False)
        .withColumn("least", F.min("fp").over(Window.partitionBy("variant")))
        .where((F.col("fp") != F.col("least")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= radius))
        .select(F.col("fp").alias("a"), F.col("least").alias("b"))
    )
    return found.unionAll(heavy)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (signed long), ``root`` and ``component_id``.

    ``component_id`` is the smallest id reachable by links, the row's own included; ``root`` is
    the least fingerprint reachable, so it tells components apart whatever their ids. Null,
    empty and blank texts have fingerprint 0 and link like any other. Equal fingerprints always
    link; repeated rows and ids come back as often as they are there. A null id takes part with
    its text but never names a component unless all its rows have null ids. An empty table gives
    no rows, and columns besides the two named are not looked at.
    """
    marked = stage(
        docs.select(F.col(id_col).alias("id"), fingerprint_of(F.col(text_col), shingle).alias("fp")), "fingerprints"
    )
    classes = stage(marked.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("fp"), radius))
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    # Only classes that are more than one row need looking up again.
    linked = roots.select("root").distinct().withColumn("linked", F.lit(True))
    several = joined.join(linked, "root", "left").where("n > 1 or linked")
    named = several.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = several.join(named, "root").select("fp", "root", "component_id")
    return marked.join(lookup, "fp", "left").select(
        F.col("id").alias(id_col),
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
