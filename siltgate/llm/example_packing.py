"""Packing of examples into sequences by vector bin packing with the dot-product heuristic.

An example asks for three things at once: tokens, a segment, and loss-bearing tokens (those a
model is trained to predict; a prompt bears none, and neither does the first token of a piece,
which nothing precedes). A sequence has a limit for each. Sequences are filled one after another:
of all examples that fit what is left, the next is the one whose asks have the greatest weighted
dot product with what is left, so that a dimension that runs short is spent sparingly. Weights
are the total asks of a group relative to the limits.

With ``cut``, a sequence that nothing fits any more is filled up by the head of the example with
the greatest dot product, whose rest goes back to the others; and a sequence that stays short
because segments or examples ran out ends at a power of two, which needs no padding.

Examples are dealt to groups of some ``GROUP`` by a hash of their place, each packed in one task.
The last, unfinished sequence of every group is packed again with those of the others, level by
level, until one group is left: its rest alone makes short sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import held_in_worker, stage

GROUP = 16_384
END = 0  # the id after every example
ID_BYTES = 4
BLOCK_BYTES = 4_000_000  # of ids in one outgoing batch


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most: tokens, segments, and tokens that bear loss."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must be at least 1")


# --- tokenizing -----------------------------------------------------------------


def byte_bpe() -> Callable[[str], np.ndarray]:
    """Ids of a text as the public byte-level tokenizer of 50,257 ids gives them.

    The ranks and the splitting pattern are those of the ``tokenizers`` file; the special token's
    text is read as its id there, and so it is here.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {"<|endoftext|>": len(ranks)}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


TOKENIZED = "doc_id bigint, start bigint, length bigint, quiet bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"


def tokenized(
    docs: DataFrame,
    tokenizer: Callable[[], Callable[[str], np.ndarray]] = byte_bpe,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),
    with_ids: bool = True,
) -> DataFrame:
    """Rows of pieces: each example's ids (prompt, text, ``END``), cut where a limit is full.

    ``quiet`` counts the tokens at a piece's start that bear no loss, ``doc_tokens`` all ids of
    the example. Null prompts and texts are empty ones. Without ``with_ids`` only pieces that
    may still be cut carry their ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encode = held_in_worker(("example ids", tokenizer), tokenizer)
        names = [part.split()[0] for part in TOKENIZED.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, prompt, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                asked = encode(prompt) if prompt else np.empty(0, np.uint32)
                answer = encode(text) if text else np.empty(0, np.uint32)
                ids = np.concatenate([asked, answer, [END]]).astype("<u4")
                for start, length, quiet in first_cuts(len(ids), len(asked), limits):
                    data = ids[start : start + length].tobytes()
                    kept = data if with_ids or length < limits.tokens else None
                    rows.append((doc, start, length, quiet, zlib.crc32(data), len(ids), kept))
                    held += len(data)
                if held > BLOCK_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)

    prompt = F.col(prompt_col) if prompt_col else F.lit(None)
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("id"), prompt.cast("string").alias("prompt"), F.col(text_col).cast("string").alias("text")
    )
    return narrow.mapInArrow(run, TOKENIZED)


def quiet_tokens(start: int, length: int, prompt: int) -> int:
    """Tokens at the start of a piece that bear no loss: the prompt's, and always the first."""
    return min(length, max(1, prompt - start))


def first_cuts(n: int, prompt: int, limits: Limits) -> Iterator[tuple[int, int, int]]:
    """(start, length, quiet) of pieces that fit an empty sequence, each as long as possible."""
    start = 0
    while start < n:
        quiet = max(1, prompt - start)
        length = min(limits.tokens, quiet + limits.loss, n - start)
        yield start, length, min(length, quiet)
        start += length


# --- packing --------------------------------------------------------------------


class Pool:
    """Examples waiting for a place; those that ask for the same are one kind."""

    def __init__(self, limits: Limits, pieces: list[tuple[int, int, int, int]]):
        self.limits = limits
        self.kinds: dict[tuple[int, int], int] = {}
        self.waiting: list[list[tuple[int, int]]] = []
        self.tokens = np.zeros(1024)
        self.loss = np.zeros(1024)
        self.alive = np.zeros(1024, dtype=bool)
        self.size = 0
        asks = np.array([[n, 1, n - quiet] for _, _, n, quiet in pieces], dtype=np.float64).reshape(-1, 3)
        capacity = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
        # An ask and what is left are both measured against the limit.
        self.weights = asks.sum(axis=0) / capacity / capacity**2
        for piece in reversed(pieces):  # so that the first of a kind is taken first
            self.add(*piece)

    def add(self, row: int, at: int, length: int, quiet: int) -> None:
        kind = self.kinds.setdefault((length, quiet), len(self.waiting))
        if kind == len(self.waiting):
            if kind == len(self.tokens):
                self.tokens, self.loss, self.alive = (np.concatenate([a, np.zeros_like(a)]) for a in (self.tokens, self.loss, self.alive))
            self.waiting.append([])
            self.tokens[kind], self.loss[kind] = length, length - quiet
        self.waiting[kind].append((row, at))
        self.alive[kind] = True
        self.size += 1

    def take(self, kind: int) -> tuple[int, int, int, int]:
        row, at = self.waiting[kind].pop()
        self.alive[kind] = bool(self.waiting[kind])
        self.size -= 1
        length = int(self.tokens[kind])
        return row, at, length, length - int(self.loss[kind])

    def best(self, tokens: int, segments: int, loss: int) -> tuple[int, bool]:
        """The kind of the greatest dot product, among those that fit if any does; and whether it fits."""
        n = len(self.waiting)
        asked, bearing, alive = self.tokens[:n], self.loss[:n], self.alive[:n]
        w = self.weights
        score = asked * (w[0] * tokens) + bearing * (w[2] * loss) + w[1] * segments
        fits = alive & (asked <= tokens) & (bearing <= loss)
        some = bool(fits.any())
        return int(np.argmax(np.where(fits if some else alive, score, -1.0))), some


def fill(
    pieces: list[tuple[int, int, int, int]], limits: Limits, cut: bool, last: bool
) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
    """(number, pieces in order) of each sequence; number -1 for one left open for the next level.

    A piece is (row, place in the row's ids, length, quiet tokens). A piece that an empty
    sequence can't hold is cut in any case.
    """
    pool = Pool(limits, pieces)
    number = 0
    while pool.size:
        tokens, segments, loss = limits.tokens, limits.segments, limits.loss
        inside: list[tuple[int, int, int, int]] = []
        while pool.size and tokens and segments:
            kind, fits = pool.best(tokens, segments, loss)
            if not fits and inside and not cut:
                break
            row, at, length, quiet = pool.take(kind)
            if not fits:
                head = min(tokens, quiet + loss, length)
                pool.add(row, at + head, length - head, quiet_tokens(head, length - head, quiet))
                length, quiet = head, min(head, quiet)
            inside.append((row, at, length, quiet))
            tokens, segments, loss = tokens - length, segments - 1, loss - (length - quiet)
        filled = limits.tokens - tokens
        if not pool.size and not last and tokens:
            yield -1, inside
            return
        if cut and tokens:
            over = filled - (1 << (filled.bit_length() - 1))
            while over:
                row, at, length, quiet = inside.pop()
                back = min(over, length)
                stay = length - back
                if stay:
                    inside.append((row, at, stay, min(stay, quiet)))
                pool.add(row, at + stay, back, quiet_tokens(stay, back, quiet))
                over -= back
        yield number, inside
        number += 1


PLACED = "row bigint, at bigint, length bigint, quiet bigint, sequence_id bigint, offset bigint"


def _pack_group(limits: Limits, cut: bool, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        rows = rows.sort_values(["length", "row", "at"], ascending=[False, True, True], kind="stable")
        pieces = list(rows[["row", "at", "length", "quiet"]].itertuples(index=False, name=None))
        placed = []
        for number, inside in fill(pieces, limits, cut, last):
            offset = 0
            for row, at, length, quiet in inside:
                placed.append((row, at, length, quiet, None if number < 0 else part * (1 << 32) + number, offset))
                offset += length
        out = pd.DataFrame(placed, columns=["row", "at", "length", "quiet", "sequence_id", "offset"])
        return out.astype({"sequence_id": "Int64"})

    return run


def pack(pieces: DataFrame, limits: Limits = Limits(), group: int = GROUP, cut: bool = True) -> DataFrame:
    """Places of all ``pieces`` (long ``row``, unique, ``length`` >= 1 and ``quiet``), as rows of PLACED.

    ``at`` is a cut piece's place in its row. Every token is placed exactly once; offsets are
    gapless from 0 in each sequence. ``pieces`` must give the same rows whenever it is read, as a
    staged table does. An empty table gives an empty one.
    """
    # A group leaves one open sequence at most; it must hold far more pieces for levels to end.
    group = max(group, 4 * limits.segments)
    narrow = pieces.select("row", F.lit(0).cast("bigint").alias("at"), "length", "quiet")
    full = F.col("length") == limits.tokens
    # A full piece needs no partner; its sequence is numbered below zero by its row.
    places = [
        narrow.where(full).select("*", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    ]
    rest = narrow.where(~full)
    first_part = 0
    while True:
        parts = max(1, -(-rest.count() // group))
        dealt = rest.withColumn("part", first_part + F.pmod(F.xxhash64("row", "at"), F.lit(parts)))
        packed = dealt.groupBy("part").applyInPandas(_pack_group(limits, cut, last=parts == 1), PLACED)
        level = stage(packed, "sequences")
        places.append(level.where("sequence_id is not null"))
        if parts == 1:
            break
        # At most one open sequence of a group comes again.
        rest = level.where("sequence_id is null").select("row", "at", "length", "quiet")
        first_part += parts
    out = places[0]
    for more in places[1:]:
        out = out.unionAll(more)
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: Callable[[], Callable[[str], np.ndarray]] = byte_bpe,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),
    group: int = GROUP,
    cut: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all rows of ``docs`` with their places in sequences.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the ids as little-endian 32-bit integers. A null, empty or missing text is the
    end id alone. Rows with repeated or null ids are examples of their own; columns of ``docs``
    but the named ones are not looked at, whatever their names. Texts of any length are read
    whole; one text must fit a task.
    """
    pieces = tokenized(docs, tokenizer, id_col, text_col, prompt_col, limits, with_ids)
    held = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "examples")
    places = pack(held, limits, group, cut).select("row", "at", F.col("length").alias("taken"), "sequence_id", "offset")
    ids = ["ids"] if with_ids else []
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *ids]
    joined = held.select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", *ids).join(places, "row")
    whole = joined.where(F.col("length") == F.col("taken")).select(columns)
    # Only pieces cut while packing need their ids again.
    part = F.substring("ids", ID_BYTES * F.col("at") + 1, ID_BYTES * F.col("taken"))
    cut_off = (
        held.where(F.col("ids").isNotNull())
        .join(places, "row")
        .where(F.col("length") != F.col("taken"))
        .withColumn("ids", part)
        .select(
            "doc_id",
            (F.col("start") + F.col("at")).alias("start"),
            F.col("taken").alias("length"),
            F.crc32("ids").alias("ids_crc32"),
            "doc_tokens",
            "sequence_id",
            "offset",
            *ids,
        )
    )
    return whole.unionAll(cut_off)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence of ``packed`` (made ``with_ids``): its ids, and where segments start."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id",
        F.aggregate("inside", F.lit(b"").cast("binary"), lambda done, piece: F.concat(done, piece["ids"])).alias("ids"),
        F.transform("inside", lambda piece: piece["offset"]).alias("segments"),
        F.transform("inside", lambda piece: F.struct(piece["doc_id"].alias("doc_id"), piece["start"].alias("start"))).alias("pieces"),
    )
