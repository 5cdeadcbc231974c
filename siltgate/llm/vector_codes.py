"""Vector codes by product quantization in whole numbers, over a trie of the distinct parts.

Components become integers, vectors are cut into equal parts, and every part position learns its
own codebook by rounds of assigning and averaging. Equal parts are counted once, before anything
is compared; sorted, they are the leaves of a trie whose levels are the dimensions of a part. A
node's vector of accumulated squared distances to all entries is worked out once and shared by
everything below it; a leaf takes the nearest entry and adds itself, weighted by its count, to
that entry's sum. All arithmetic is in integers, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LEAVES = 2048  # of a subtree, or of neighbouring ones, whose levels are worked out as arrays
SALTS = 32
LARGEST = 2.0**62  # a component times the scale must stay below

Books = list[np.ndarray]  # per part position: entries by dimensions


def finite(vector: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole_numbers(vector: str, scale: int) -> Column:
    def whole(x: Column) -> Column:
        scaled = x.cast("double") * float(scale)
        return F.when(F.abs(scaled) < LARGEST, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is too large")).cast("bigint"))

    return F.transform(F.col(vector), whole)


# --- the trie -------------------------------------------------------------------


def exact(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if no sum of squares can leave that range, else as Python's."""
    largest = max((int(abs(a).max()) for a in (rows, book) if a.size), default=0)
    if (2 * largest) ** 2 * max(1, rows.shape[1]) < 2**62:
        return rows, book
    return rows.astype(object), book.astype(object)


def leaf_distances(rows: np.ndarray, book: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, squared distances of these rows to every entry), depth first over the trie.

    ``rows`` are in lexicographic order. The stack holds subtrees (from, to, depth, accumulated
    distances of the path to it). A subtree of many leaves is split into its children; children
    of few leaves stay together and are finished as arrays.
    """
    rows, book = exact(rows, book)
    width = rows.shape[1]
    stack = [(0, len(rows), 0, np.zeros(len(book), dtype=rows.dtype))]
    while stack:
        low, high, depth, path = stack.pop()
        if high - low <= LEAVES or depth == width:
            yield low, high, _levels(rows[low:high], book, depth, path)
            continue
        column = rows[low:high, depth]
        starts = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1, [high - low]])
        below = []
        first = 0
        for child in range(len(starts) - 1):
            leaves = starts[child + 1] - starts[child]
            if leaves > LEAVES:
                if starts[child] > first:
                    below.append((low + first, low + starts[child], depth, path))
                step = column[starts[child]] - book[:, depth]
                below.append((low + starts[child], low + starts[child + 1], depth + 1, path + step * step))
                first = starts[child + 1]
            elif starts[child + 1] - first > LEAVES:
                below.append((low + first, low + starts[child], depth, path))
                first = starts[child]
        if first < high - low:
            below.append((low + first, high, depth, path))
        stack.extend(reversed(below))


def _levels(rows: np.ndarray, book: np.ndarray, depth: int, path: np.ndarray) -> np.ndarray:
    """Distances of few leaves under one path: each level's nodes once, from their parents'."""
    new = np.ones(rows[:, depth:].shape, dtype=bool)
    new[1:] = np.logical_or.accumulate(rows[1:, depth:] != rows[:-1, depth:], axis=1)
    nodes, parent = path[None, :], np.zeros(len(rows), dtype=np.int64)
    for level in range(new.shape[1]):
        starts = np.flatnonzero(new[:, level])
        step = rows[starts, depth + level][:, None] - book[:, depth + level][None, :]
        nodes = nodes[parent[starts]] + step * step
        parent = np.cumsum(new[:, level]) - 1
    return nodes[parent]


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, ties to the lower index, and its squared distance."""
    at = np.empty(len(rows), dtype=np.int64)
    distance = np.empty(len(rows), dtype=object)
    for low, high, found in leaf_distances(rows, book):
        best = np.argmin(found, axis=1)
        at[low:high] = best
        distance[low:high] = found[np.arange(len(found)), best]
    return at, distance


# --- rounds ---------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _sums(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows (pos, part, n): each entry's count and componentwise weighted sum, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), dtype=object) for book in books]
        sums = [np.zeros(book.shape, dtype=object) for book in books]
        width = books[0].shape[1]
        for batch in batches:
            positions = batch.column(0).to_numpy()
            parts, weights = _matrix(batch.column(1), width), batch.column(2).to_numpy()
            for position in np.unique(positions):
                here = np.flatnonzero(positions == position)
                rows, weight = parts[here], weights[here]
                at, _ = nearest(rows, books[position])
                for entry in np.unique(at):
                    mine = at == entry
                    counts[position][entry] += int(weight[mine].sum())
                    weighted, w = exact_product(rows[mine], weight[mine])
                    sums[position][entry] += (weighted * w[:, None]).sum(axis=0)
        out = [
            (position, entry, dim, str(sums[position][entry, dim]), int(counts[position][entry]))
            for position, book in enumerate(books)
            for entry in range(len(book))
            if counts[position][entry]
            for dim in range(width)
        ]
        columns = list(zip(*out)) if out else [()] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["pos", "entry", "dim", "total", "n"])

    return run


def exact_product(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if the weighted sum stays in that range, else as Python's."""
    if int(abs(rows).max()) * int(weight.sum()) < 2**62:
        return rows, weight
    return rows.astype(object), weight.astype(object)


def averaged(parts: DataFrame, books: Books) -> Books:
    """The books after one round: entries with parts become their floored mean.

    What comes to the driver is one number per entry and dimension, whatever the table's size.
    """
    found = parts.select("pos", "part", "n").mapInArrow(_sums(books), "pos int, entry int, dim int, total string, n bigint")
    totals = found.groupBy("pos", "entry", "dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    new = [book.copy() for book in books]
    for row in totals.collect():
        new[row["pos"]][row["entry"], row["dim"]] = int(row["total"]) // row["n"]
    return new


def distinct_parts(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """Staged rows (pos, part, n): each position's distinct parts and how often they occur.

    Counted before the shuffle, so copies of one vector cost one row a task; sorted within each
    partition, so that its rows are the leaves of a trie in order.
    """
    cuts = F.array(*[F.slice("vector", 1 + i * width, width) for i in range(parts)])
    rows = vectors.select(F.posexplode(cuts).alias("pos", "part"))
    counted = rows.groupBy("pos", "part").agg(F.count("*").alias("n"))
    return stage(counted.sortWithinPartitions("pos", "part"), "parts")


class Codes:
    """What ``compress`` gives: rows (id, label, code, error), and the books the codes point into."""

    def __init__(self, rows: DataFrame, books: Books):
        self.rows, self.books = rows, books

    def digest(self) -> str:
        numbers = (str(int(x)) for book in self.books for x in book.reshape(-1))
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


CODED = "id bigint, label string, code string, error bigint"


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codes:
    """Codes of all usable vectors, one byte of hex per part.

    Rows whose vector is null or holds a null or non-finite component are left out. The vectors'
    width is that of the smallest id's; those of another width are left out, and a width that
    the parts do not divide is filled up with zeros. Books start from the smallest ids (null ids
    last, equal ids by vector); with fewer vectors than entries they are that much smaller.
    Repeated rows count as often as they occur. Other columns, whatever their names, are not
    looked at. An empty table gives empty rows and no books. ``vectors`` is read several times.
    """
    label = F.col(label_col) if label_col else F.lit(None)
    kept = vectors.where(finite(vector_col)).select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"), whole_numbers(vector_col, scale).alias("vector")
    )
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*order).select(F.size("vector").alias("width")).first()
    if first is None:
        return Codes(kept.sparkSession.createDataFrame([], CODED), [])
    width = -(-first["width"] // parts)
    filled = F.concat("vector", F.array_repeat(F.lit(0).cast("bigint"), width * parts - first["width"]))
    kept = kept.where(F.size("vector") == first["width"]).withColumn("vector", filled)
    starts = np.array([r["vector"] for r in kept.orderBy(*order).limit(entries).collect()], dtype=np.int64)
    starts = starts.reshape(len(starts), parts, width)
    books = [starts[:, position].copy() for position in range(parts)]
    leaves = distinct_parts(kept, width, parts)
    for _ in range(rounds):
        books = averaged(leaves, books)
    return Codes(kept.mapInArrow(_code(books), CODED), books)


def _code(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        for batch in batches:
            n = len(batch)
            vectors = _matrix(batch.column(2), width * len(books)).reshape(n, len(books), width)
            at = np.empty((n, len(books)), dtype=np.uint8)
            error = np.zeros(n, dtype=object)
            for position, book in enumerate(books):
                rows = vectors[:, position]
                order = np.lexsort(rows.T[::-1]) if width else np.arange(n)
                rows = rows[order]
                # A leaf is worked out once, however many rows of the batch hold it.
                new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
                best, distance = nearest(rows[new], book)
                leaf = np.cumsum(new) - 1
                at[order, position] = best[leaf]
                error[order] += distance[leaf]
            codes = [row.tobytes().hex() for row in at]
            columns = [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return run


def decode(code: str, books: Books, scale: int = SCALE) -> np.ndarray:
    """The vector a code stands for: its entries' components, at the middle of their steps."""
    at = bytes.fromhex(code)
    return np.concatenate([(book[i] + 0.5) / scale for i, book in zip(at, books)])


def with_label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of ``error`` over their label (nulls together) as ``label_error``.

    Sums are spread over ``SALTS`` keys, so that a label of very many rows is no single task's.
    """
    sums = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    spread = sums.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_part"))
    return salted.join(spread, same).select(*rows.columns, "label_error")
