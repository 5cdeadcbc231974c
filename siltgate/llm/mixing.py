"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets are filled like water: each source gets its weighted share of the mix, sources at their
cap stop, and the rest is shared again. The mix is then a number of equal-token blocks. Block
seats go to sources by the highest quotients target / (2 k + 1), k being the seats a source has
already; the order of those quotients, cut into equal runs, gives every output shard its whole
number of blocks from each source.

A source's documents, in a seeded order, are cut into blocks where a block's worth of words
begins, so a document is in one block. Which blocks are drawn is seeded too: they come in the
order of a hash, those of a first pass before any of a second, and fill the source's quota of
one shard after another. How many words a source gives in all is dealt in single words by the same
quotients: the last block drawn is cut there, and sources smaller than a block get their target
too. So documents are taken whole but for one a source.

There are at most ``SEATS`` blocks in the mix; the block size follows from that, and what is kept
per block is bounded by it and the number of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.llm.common import ROW_BITS, n_words, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2
SEATS = 100_000
SHARDS = 16
SEED = 7
CHUNK = 20_000  # documents whose sizes are summed in one window


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: source, source_size, weight, target.

    ``sizes`` has columns source and size. Sources are ranked by code point, null last, and the
    weights repeat along that order. The table is one row per source from here on.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # UTF-8 bytes compare like code points.
    ranked = stage(
        _numbered(by_source, F.col("source").isNull(), F.col("source").cast("binary"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")))
        .drop("number"),
        "sources",
    )
    # Sources reach their caps in order of cap / weight. With the first k at their caps, the
    # level of the others is (total - caps) / (their weight); k is right once the next does not reach its cap.
    capped = F.col("source_size") * cap
    fill = _with_totals(ranked.withColumn("reach", capped / F.col("weight")), "reach", {"caps_before": capped, "weight_before": F.col("weight")})
    # Single numbers, read like any run setting.
    whole = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, all_weights = (whole[0] or 0) * share, whole[1] or 0.0
    fits = fill.withColumn("level", (F.lit(total) - F.col("caps_before")) / (F.lit(all_weights) - F.col("weight_before")))
    level = fits.where("level <= reach").agg(F.min_by("level", "reach")).first()[0]
    filled = capped if level is None else F.least(capped.cast("double"), F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", filled.cast("double").alias("target"))


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with their place in ``order`` as ``number``, without one task holding all of them."""
    placed = stage(rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    # One row per partition of the sort.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn("number", F.col("_before") + F.col("_place").bitwiseAND((1 << ROW_BITS) - 1))
        .drop("_part", "_place", "_before")
    )


def _with_totals(rows: DataFrame, order: str, sums: dict[str, Column]) -> DataFrame:
    """Running totals of earlier rows, by chunks of the numbered rows."""
    numbered = _numbered(rows, F.col(order), F.col("source").cast("binary")).withColumns(
        {**{f"_{n}": c for n, c in sums.items()}, "_chunk": F.expr(f"number div {CHUNK}")}
    )
    chunk_totals = numbered.groupBy("_chunk").agg(*[F.sum(f"_{n}").alias(f"_all_{n}") for n in sums])
    over = Window.orderBy("_chunk")
    offsets = chunk_totals.select(
        "_chunk", *[(F.sum(f"_all_{n}").over(over) - F.col(f"_all_{n}")).alias(f"_off_{n}") for n in sums]
    )
    inside = Window.partitionBy("_chunk").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.join(offsets, "_chunk").withColumns(
        {n: F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)) + F.col(f"_off_{n}") for n in sums}
    )


def block_size(goals: DataFrame, seats: int = SEATS) -> int:
    """Words of a block, so that the mix has at most ``seats`` of them."""
    return max(1, -(-int(goals.agg(F.sum("target")).first()[0] or 0.0) // seats))


def quotas(goals: DataFrame, seats: int = SEATS, shards: int = SHARDS, cap: int = CAP) -> DataFrame:
    """Rows (source, shard, blocks, block): whole numbers of blocks of ``block`` words per shard."""
    summed = goals.agg(F.sum("target"), F.count("*")).first()
    total, sources = summed[0] or 0.0, summed[1]
    block = block_size(goals, seats)
    wanted = max(1, int(total) // block)
    # Rounding among n sources shifts a source's seats by its share of n; no later quotient can win.
    slack = F.ceil(F.col("target") / F.lit(total or 1.0) * sources) + 2
    most = F.floor(F.col("source_size") * cap / block)
    bids = (
        goals.withColumn("bids", F.least(most, F.floor(F.col("target") / block) + slack).cast("bigint"))
        .where("bids > 0")
        .select("source", "target", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bids") - 1)).alias("k"))
        .withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
    )
    seated = _numbered(bids, F.col("quotient").desc(), F.col("source").isNull(), F.col("source").cast("binary"))
    return (
        seated.where(F.col("number") < wanted)
        .withColumn("shard", F.expr(f"cast(number * {shards} div {wanted} as int)"))
        .groupBy("source", "shard")
        .agg(F.count("*").alias("blocks"))
        .withColumn("block", F.lit(block).cast("bigint"))
    )


def words_given(goals: DataFrame, cap: int = CAP) -> DataFrame:
    """Rows (source, drawn): the words each source gives, dealt one by one to the highest quotients.

    Only the words near a source's target are in question, so there are few bids a source however
    many words it has. Should any source win or lose all of its bids, more of them are called.
    """
    summed = goals.agg(F.sum("target"), F.count("*")).first()
    total, sources = summed[0] or 0.0, summed[1]
    wanted = int(total + 0.5)
    spread = 1
    while True:
        slack = F.ceil(F.col("target") / F.lit(total or 1.0) * (sources**0.5 * spread)) + 1 + spread
        called = stage(
            goals.select("source", "target", F.floor("target").alias("_whole"), (F.col("source_size") * cap).alias("most"))
            .withColumn("low", F.greatest(F.lit(0), F.col("_whole") - slack).cast("bigint"))
            .withColumn("high", F.least("most", F.col("_whole") + slack).cast("bigint"))
            .drop("_whole"),
            "called",
        )
        left = wanted - (called.agg(F.sum("low")).first()[0] or 0)
        bids = (
            called.where("high > low")
            .select("source", "target", F.explode(F.sequence("low", F.col("high") - 1)).alias("k"))
            .withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
        )
        seated = _numbered(bids, F.col("quotient").desc(), F.col("source").isNull(), F.col("source").cast("binary"))
        won = seated.where(F.col("number") < left).groupBy("source").agg(F.count("*").alias("won"))
        given = stage(
            called.join(won, called["source"].eqNullSafe(won["source"]), "left").select(
                called["source"], "low", "high", "most", F.coalesce("won", F.lit(0)).alias("won")
            ),
            "given",
        )
        if given.where("(won = 0 and low > 0) or (low + won = high and high < most)").isEmpty():
            return given.select("source", (F.col("low") + F.col("won")).alias("drawn"))
        spread *= 4


def drawn_blocks(
    placed: DataFrame, goals: DataFrame, block: int, quota: DataFrame, cap: int = CAP, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """Rows (source, block, first, takes): which blocks of each source are drawn.

    ``placed`` has source, size and start of every document; ``goals`` has source and drawn.
    ``first`` is where a block's first document starts, ``takes`` an entry (pass, words, shard) for
    each time the block is drawn. Blocks come by pass and hash until the source's words are
    reached; the first of them fill the shards' quotas in turn, and one that is left over (the
    rest of words, or documents that make a block smaller) goes to the next shard round.
    """
    blocks = placed.where("size > 0").groupBy("source", F.expr(f"start div {block}").alias("block")).agg(
        F.sum("size").alias("size"), F.min("start").alias("first")
    )
    passes = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("pass"))
    # At most the seats and one block per source, so a source's blocks fit a window.
    order = Window.partitionBy("source").orderBy("pass", F.xxhash64(F.lit(seed), "source", "block", "pass"), "block")
    ranked = passes.withColumns(
        {
            "rank": F.row_number().over(order) - 1,
            "before": F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    called = goals.select(F.col("source").alias("_source"), "drawn")
    words = F.least(F.col("size"), F.col("drawn") - F.col("before"))
    taken = ranked.join(called, ranked["source"].eqNullSafe(called["_source"])).withColumn("words", words).where("words > 0")
    earlier = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    seats = quota.withColumn("_low", F.coalesce(F.sum("blocks").over(earlier), F.lit(0))).select(
        F.col("source").alias("_of"), "shard", F.explode(F.expr("sequence(_low, _low + blocks - 1)")).alias("_rank")
    )
    dealt = taken.join(seats, taken["source"].eqNullSafe(seats["_of"]) & (F.col("rank") == F.col("_rank")), "left")
    shard = F.coalesce("shard", F.pmod(F.col("rank"), F.lit(shards)).cast("int"))
    return dealt.groupBy("source", "block").agg(
        F.min("first").alias("first"),
        F.sort_array(F.collect_list(F.struct("pass", "words", shard.alias("shard")))).alias("takes"),  # one a pass
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seats: int = SEATS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """All rows of ``docs`` as doc_id, source, row, size, source_size, target, taken, shards.

    ``taken`` counts the words the mix takes of a document, repeats included, 0 to ``cap`` times
    its size: some whole passes over it and then its first words. ``shards`` says which output
    shard gets how many of them, an entry a pass. Null and blank texts have size 0 and are never
    taken; a null source is a source of its own, ranked last. Rows with equal ids are separate
    documents, told apart by a hash of id, text and source; rows equal in these share it, and
    their order does not matter. Reruns agree. Empty tables give no rows.
    """
    row = row_hash(id_col, text_col, source_col, seed)
    held = stage(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), row.alias("row")
        ),
        "sizes",
    )
    goals = stage(targets(held, weights, share, cap), "targets")
    given = words_given(goals, cap).withColumnRenamed("source", "_source")
    goals = stage(
        goals.join(given, goals["source"].eqNullSafe(given["_source"])).select("source", "source_size", "target", "drawn"), "goals"
    )
    block = block_size(goals, seats)
    placed = stage(_word_places(held), "places")
    chosen = drawn_blocks(placed, goals, block, quotas(goals, seats, shards, cap), cap, shards, seed)
    chosen = stage(chosen, "blocks").toDF("_source", "_block", "_first", "_takes")
    here = F.expr(f"start div {block}")
    found = placed.join(chosen, placed["source"].eqNullSafe(chosen["_source"]) & (here == F.col("_block")), "left")
    # A block's words are its first ones, so the document that it is cut in keeps its first words.
    offset = F.col("start") - F.col("_first")

    def of_pass(take: Column) -> Column:
        words = F.greatest(F.lit(0), F.least(F.col("size"), take["words"] - offset)).cast("bigint")
        return F.struct(take["shard"].alias("shard"), words.alias("words"))

    entries = F.filter(F.transform("_takes", of_pass), lambda entry: entry["words"] > 0)
    none = F.expr("cast(array() as array<struct<shard: int, words: bigint>>)")
    found = found.withColumn("_entries", F.when((F.col("size") > 0) & F.col("_takes").isNotNull(), entries).otherwise(none))
    named = goals.select(F.col("source").alias("_named"), "source_size", "target")
    return found.join(named, found["source"].eqNullSafe(named["_named"])).select(
        "doc_id",
        "source",
        "row",
        "size",
        "source_size",
        "target",
        F.aggregate("_entries", F.lit(0).cast("bigint"), lambda done, entry: done + entry["words"]).alias("taken"),
        F.col("_entries").alias("shards"),
    )


def row_hash(id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> Column:
    """The seeded place of a document among those of its source."""
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), F.col(source_col))


def _word_places(held: DataFrame) -> DataFrame:
    """``held`` with ``start``: the words of earlier documents in the source's seeded order.

    The order is by ``row``, a hash; equal ranges of it are chunks, summed on their own, so a
    source of any size is spread over many tasks.
    """
    bits = max(0, (held.count() // CHUNK).bit_length())
    chunk = F.shiftrightunsigned("row", 64 - bits) if bits else F.lit(0)
    cut = held.withColumn("chunk", chunk.cast("bigint"))
    sums = cut.groupBy("source", "chunk").agg(F.sum("size").alias("_all"))
    # One row per source and chunk.
    over = Window.partitionBy("source").orderBy("chunk")
    offsets = sums.select("source", "chunk", (F.sum("_all").over(over) - F.col("_all")).alias("_before"))
    unsigned = F.col("row").bitwiseXOR(-(1 << 63))  # compares as the chunks do
    inside = Window.partitionBy("source", "chunk").orderBy(unsigned, "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return local.join(
        offsets, local["source"].eqNullSafe(offsets["source"]) & (local["chunk"] == offsets["chunk"])
    ).select(local["doc_id"], local["source"], "row", "size", (F.col("_before") + F.col("_local")).alias("start"))
