"""Best-fit packing of tokenized documents by vector best-fit.

An item asks for three things at once: tokens, a document, and attention cost (its length
squared). A sequence has a capacity for each. Items are placed largest first; of the open
sequences with room in every dimension the best is chosen by one of two rules:

* ``norm``: the smallest residual norm after placing,
* ``dot``: the largest weighted dot product of what the item asks for and what is left.

Documents are cut into groups of some ``GROUP`` pieces by a hash of their place, and each group
is packed on its own. A second pass takes apart the sequences that stayed emptier than
``LOOSE`` and packs their pieces again across groups, so the loss does not add up per group.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import held_in_worker, stage

TOKENS = 2048
GROUP = 16_384
LOOSE = 0.98
END = 0  # the id after every document
CACHED_BYTES = 72_000_000  # of one generation of looked-up parts
ENTRY_BYTES = 180  # what an entry takes beside its part and ids
BLOCK_BYTES = 2_000_000  # texts are looked up together until they have so many
LEARNT_PARTS = 8_192  # encoded at once
MARKS = string.punctuation.encode()

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence. The defaults for documents and attention hold for any full sequence."""

    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS * TOKENS
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"


# --- tokenizing -----------------------------------------------------------------


class WordIds:
    """Token ids of texts as little-endian 32-bit bytes, looked up word by word.

    The tokenizer drops white space, ignores case and never merges across white space or between
    letters and punctuation, so a text's ids are those of its white-space-delimited parts in a
    row, and a tail of ASCII marks after an ASCII letter or digit is a part of its own. Texts are
    looked up in blocks of some ``BLOCK_BYTES``. Parts seen before come from a cache of two
    generations of at most ``CACHED_BYTES``: when the younger is full it replaces the older.
    Texts that may hold special tokens are read whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the younger generation
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = [s.encode() for s in specials]
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.ends[ends] = True

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
        """Blocks of binary ``texts`` in order: the first text's place and the ids of each text."""
        sizes = pc.binary_length(texts).fill_null(0).to_pylist()
        first, held = 0, 0
        for at, size in enumerate(sizes):
            if at > first and held + size > BLOCK_BYTES:
                yield first, self._block(texts.slice(first, at - first).to_pylist())
                first, held = at, 0
            held += size
        if first < len(sizes):
            yield first, self._block(texts.slice(first).to_pylist())

    def _block(self, texts: list[bytes | None]) -> list[bytes]:
        parts: list[bytes] = []
        stops: list[int | bytes] = []  # where a text's parts stop, or the ids of one read whole
        for text in texts:
            if text and any(s in text for s in self.specials):
                stops.append(array("I", self._ids([text.decode("utf-8", "replace")])[0]).tobytes())
                continue
            if text:
                parts += text.lower().split()
            stops.append(len(parts))
        ids = self._found(parts)
        joined, start = [], 0
        for stop in stops:
            if isinstance(stop, bytes):
                joined.append(stop)
            else:
                joined.append(b"".join(ids[start:stop]))
                start = stop
        return joined

    def _found(self, parts: list[bytes]) -> list[bytes]:
        """The ids of parts; those not known are learnt in steps, which bounds what encoding holds."""
        ids = list(map(self.known.get, parts))
        gaps = [at for at, found in enumerate(ids) if found is None]
        if gaps:
            missing = list({parts[at] for at in gaps})
            found = dict(zip(missing, map(self.older.get, missing)))
            new = [part for part, known in found.items() if known is None]
            if len(new) < len(found):
                self._keep({part: known for part, known in found.items() if known is not None})
            for start in range(0, len(new), LEARNT_PARTS):
                found.update(self._learn(new[start : start + LEARNT_PARTS]))
            for at in gaps:
                ids[at] = found[parts[at]]
        return ids

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; places in the text are not asked for, which halves the time."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """The ids of distinct ``parts`` that are in neither generation, which are then in the younger."""
        learnt: dict[bytes, bytes] = {}
        new = set(parts)
        # Letters and a tail of marks are two parts; the tails are few.
        marked = []
        for part in new:
            if not part[-1:].isalnum():
                head = part.rstrip(MARKS)
                if head != part and head[-1:].isalnum():
                    marked.append((part, head, part[len(head) :]))
        if marked:
            new.difference_update([m[0] for m in marked])
            for half in {m[1] for m in marked} | {m[2] for m in marked}:
                ids = self.known.get(half) or self.older.get(half)
                if ids is None:
                    new.add(half)
                else:
                    learnt[half] = ids
        words = {p: p.decode("utf-8", "replace") for p in new}
        plain = [p for p, w in words.items() if w.isalpha()]
        if plain:
            # Words of letters end in exactly one closing token each, so they can be encoded in a row.
            row = " ".join(map(words.__getitem__, plain))
            ids = np.array(self._ids([row])[0], dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(plain):
                joined, stops = ids.tobytes(), (4 * cuts).tolist()
                learnt.update((p, joined[i:j]) for p, i, j in zip(plain, [0, *stops], stops))
                new.difference_update(plain)
        rest = list(new)
        for part, ids in zip(rest, self._ids([words[p] for p in rest])):
            learnt[part] = array("I", ids).tobytes()
        for part, head, tail in marked:
            learnt[part] = learnt[head] + learnt[tail]
        self._keep(learnt)
        return learnt

    def _keep(self, found: dict[bytes, bytes]) -> None:
        added = sum(map(len, found)) + sum(map(len, found.values())) + ENTRY_BYTES * len(found)
        if self.held + added > CACHED_BYTES:
            self.known, self.older, self.held = {}, self.known, 0
        self.known.update(found)
        self.held += added


def word_ids(path: str) -> WordIds:
    """One tokenizer per worker process and file."""
    return held_in_worker(("tokenizer", path), lambda: WordIds(path))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def tokenized(
    docs: DataFrame,
    tokenizer: Callable[[], str] = default_tokenizer,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: int = TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """Rows of pieces with their ids: each document's ids, then ``END``, cut every ``tokens``."""

    n = 6 if with_ids else 5
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:n]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:n]

    def run(batches):
        words = word_ids(tokenizer())
        step, end = 4 * tokens, array("I", [END]).tobytes()
        for batch in batches:
            for first, texts in words.blocks(batch.column(1)):
                rows: list[tuple] = []
                for doc, found in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts):
                    found += end
                    for piece, at in enumerate(range(0, len(found), step)):
                        ids = found[at : at + step]
                        rows.append((doc, piece, at // 4, len(ids) // 4, zlib.crc32(ids), ids)[:n])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


# --- packing --------------------------------------------------------------------


def best_fit(lengths: np.ndarray, limits: Limits) -> np.ndarray:
    """The sequence number of each item; numbers are gapless from 0."""
    order = np.argsort(-lengths, kind="stable")
    place = np.empty(len(lengths), dtype=np.int64)
    capacity = np.array([limits.tokens, limits.documents, limits.attention], dtype=np.float64)
    weights = np.array(limits.weights)
    # What is left of each open sequence; the arrays grow as needed.
    left = np.empty((1024, 3), dtype=np.int64)
    number = np.empty(1024, dtype=np.int64)
    open_, made = 0, 0
    smallest = int(lengths.min()) if len(lengths) else 0
    for item in order:
        n = int(lengths[item])
        ask = np.array([n, 1, n * n])
        rest = left[:open_] - ask
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            if limits.rule == "dot":
                score = -((left[fits] / capacity) * (ask / capacity) * weights).sum(axis=1)
            else:
                score = (((rest[fits] / capacity) ** 2) * weights).sum(axis=1)
            at = int(fits[np.argmin(score)])
            left[at] = rest[at]
        else:
            if open_ == len(left):
                left, number = np.concatenate([left, left]), np.concatenate([number, number])
            at, open_ = open_, open_ + 1
            left[at], number[at] = capacity.astype(np.int64) - ask, made
            made += 1
        place[item] = number[at]
        if left[at, 0] < smallest or left[at, 1] < 1:  # nothing fits any more
            open_ -= 1
            left[at], number[at] = left[open_], number[open_]
    return place


def _pack_group(limits: Limits) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True], kind="stable")
        rows["sequence"] = best_fit(rows["length"].to_numpy(), limits)
        rows = rows.sort_values(["sequence", "length", "row"], ascending=[True, False, True], kind="stable")
        by = rows.groupby("sequence")["length"]
        rows["offset"] = by.cumsum() - rows["length"]
        rows["filled"] = by.transform("sum")
        rows["sequence_id"] = rows["part"] * (1 << 32) + rows["sequence"]
        return rows[["row", "length", "part", "sequence_id", "offset", "filled"]]

    return run


PLACED = "row bigint, length bigint, part bigint, sequence_id bigint, offset bigint, filled bigint"


def pack(pieces: DataFrame, limits: Limits = Limits(), group: int = GROUP) -> DataFrame:
    """``pieces`` (with a long ``length`` of 1 to ``limits.tokens``) with ``sequence_id`` and ``offset``.

    Every piece is placed exactly once and offsets are gapless from 0 in each sequence. Equal
    pieces and repeated ids are separate items. The input is staged with a row number first, so
    a lost executor cannot deal rows to other groups. An empty table gives an empty one.
    """
    if limits.attention < limits.tokens**2 or limits.documents < 1:
        raise ValueError("a piece of full length must fit an empty sequence")
    held = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    # Row hashes deal pieces evenly whatever their ids or texts; full pieces need no partner.
    narrow = held.select("row", "length")
    alone = narrow.where(F.col("length") == limits.tokens)
    rest = narrow.where(F.col("length") < limits.tokens)
    parts = max(1, -(-rest.count() // group))
    first = stage(
        rest.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
        .groupBy("part")
        .applyInPandas(_pack_group(limits), PLACED),
        "packed",
    )
    # Loosely filled sequences of all groups are packed once more, together.
    loose = F.col("filled") < int(LOOSE * limits.tokens)
    again = first.where(loose)
    parts_again = max(1, -(-again.count() // group))
    second = (
        again.select("row", "length")
        .withColumn("part", parts + F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts_again)))
        .groupBy("part")
        .applyInPandas(_pack_group(limits), PLACED)
    )
    columns = ["row", "sequence_id", "offset"]
    places = (
        first.where(~loose)
        .select(*columns)
        .unionAll(second.select(*columns))
        # A sequence of its own, numbered below zero by its row.
        .unionAll(alone.select("row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
    )
    return held.join(places, "row").drop("row")


def pack_documents(
    docs: DataFrame,
    tokenizer: Callable[[], str] = default_tokenizer,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: Limits = Limits(),
    group: int = GROUP,
) -> DataFrame:
    """Pieces of ``docs`` with their places; the ids themselves come from ``tokenized``.

    A null, empty or blank text is one piece, the end id alone. Texts of any length are cut,
    never dropped. Rows with repeated or null ids are documents of their own.
    """
    return pack(tokenized(docs, tokenizer, id_col, text_col, limits.tokens, with_ids=False), limits, group)
