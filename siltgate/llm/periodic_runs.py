"""Runs of repeated words in texts: stretches that keep a period for two rounds or more.

Suffixes of a text that start alike are brought together in order of how long they stay alike:
a forest grown over neighbours in the suffix order, longest common prefix (LCP) first, as Kruskal
grows one over edges. A class of suffixes holds its positions in order; where two classes are
united, positions that become neighbours at a distance d no larger than the LCP l show the text
repeating itself after d words for l words: a run of period d over d + l words. It is reported
where it starts, so each run comes once, and neighbours in position order cannot share a period
smaller than their distance.

A run of at least ``shortest`` words has two suffixes alike for half as many. So suffixes come in
only if their first words occur again in the text: most texts have none and cost one sort.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST = 12
BLOCK_WORDS = 200_000  # words of short texts that are looked at together

FOUND = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Run = tuple[int, int, int]  # start, length, period


def repeated(codes: np.ndarray, text: np.ndarray, gram: int) -> np.ndarray:
    """Positions whose ``gram`` words occur at another place of the same text.

    Told by a hash: a collision brings in a position too many, which costs time and no result.
    """
    n = len(codes) - gram + 1
    if n < 2:
        return np.empty(0, dtype=np.int64)
    key = text[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(gram):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[i : n + i].astype(np.uint64)
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    inside = np.flatnonzero(text[:n] == text[gram - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    return np.sort(order[again])


def suffix_names(codes: np.ndarray, marked: np.ndarray) -> list[np.ndarray]:
    """Level k names the 2^k words from each position, in order; the last tells all ``marked`` apart.

    ``codes`` must end in a code of its own, so that no two suffixes are equal.
    """
    names = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    step = 1
    while step < len(codes):
        name = names[-1]
        at = np.sort(name[marked])
        if (at[1:] != at[:-1]).all():
            break
        after = np.zeros(len(name), dtype=np.int64)
        after[:-step] = name[step:] + 1
        names.append(np.unique(name * (len(name) + 1) + after, return_inverse=True)[1].astype(np.int64))
        step *= 2
    return names


def common_prefixes(names: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many words the suffixes at ``left`` and ``right`` share."""
    alike = np.zeros(len(left), dtype=np.int64)
    last = len(names[0]) - 1
    for level in range(len(names) - 1, -1, -1):
        a, b = left + alike, right + alike
        same = names[level][np.minimum(a, last)] == names[level][np.minimum(b, last)]
        alike += np.where(same & (a <= last) & (b <= last), 1 << level, 0)
    return alike


def grow(positions: list[int], alike: list[int], codes: np.ndarray, first: int, shortest: int) -> Iterator[Run]:
    """Runs of one text, by uniting neighbours of the suffix order from the most alike downwards.

    ``positions`` are in suffix order; ``alike[i]`` is what ``positions[i]`` shares with the
    next. ``first`` is where the text starts in ``codes``.
    """
    least = (shortest + 1) // 2
    parent = list(range(len(positions)))
    ordered: list[list[int]] = [[p] for p in positions]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = [i for i, shared in enumerate(alike) if shared >= least]
    edges.sort(key=alike.__getitem__, reverse=True)
    for edge in edges:
        shared = alike[edge]
        small, large = root(edge), root(edge + 1)
        if len(ordered[small]) > len(ordered[large]):
            small, large = large, small
        coming, there = ordered[small], ordered[large]
        pairs = []
        for i, x in enumerate(coming):
            at = bisect_left(there, x)
            # Neighbours that were in one class before are nothing new.
            if at and (i == 0 or coming[i - 1] < there[at - 1]):
                pairs.append((there[at - 1], x))
            if at < len(there) and (i + 1 == len(coming) or coming[i + 1] > there[at]):
                pairs.append((x, there[at]))
            there.insert(at, x)
        ordered[small] = []
        parent[small] = large
        for i, j in pairs:
            period = j - i
            if period <= shared and period + shared >= shortest and (i == first or codes[i - 1] != codes[j - 1]):
                yield i - first, period + shared, period


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[Run]]:
    """The runs of each text, a list of words, by start and period."""
    found: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    words = [word for text in texts for word in text]
    if not words:
        return found
    codes = pd.factorize(np.fromiter(words, dtype=object, count=len(words)))[0].astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    marked = repeated(codes, text, (shortest + 1) // 2)
    if not len(marked):
        return found
    # Only texts with a repetition go on, each ending in a code of its own.
    active = np.unique(text[marked])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    new_begins = np.concatenate([[0], np.cumsum(sizes[active] + 1)])
    joined = np.empty(new_begins[-1], dtype=np.int64)
    top = int(codes.max()) + 1
    for i, t in enumerate(active):
        joined[new_begins[i] : new_begins[i + 1] - 1] = codes[begins[t] : begins[t + 1]]
        joined[new_begins[i + 1] - 1] = top + i
    which = np.searchsorted(active, text[marked])
    marked = marked - begins[active[which]] + new_begins[which]
    names = suffix_names(joined, marked)
    order = np.lexsort((names[-1][marked], which))
    marked, which = marked[order], which[order]
    alike = common_prefixes(names, marked[:-1], marked[1:])
    stops = np.concatenate([np.flatnonzero(which[1:] != which[:-1]) + 1, [len(marked)]])
    start = 0
    for stop in stops:
        i = int(which[start])
        runs = grow(marked[start:stop].tolist(), alike[start : stop - 1].tolist(), joined, int(new_begins[i]), shortest)
        found[active[i]] = sorted(runs, key=lambda run: (run[0], run[2]))
        start = stop
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that any run holds after its first period, one space apart."""
    if not runs:
        return b" ".join(words)
    keep = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        keep[start + period : start + length] = bytes(length - period)
    return b" ".join(compress(words, keep))


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Rows (doc_id, runs, collapsed) of all ``docs``, one each.

    ``runs`` holds start, length and smallest period of every stretch of at least ``shortest``
    words and two periods that no neighbouring word extends, by start and period. ``collapsed``
    is the text without the repetitions. ``prepare`` may change a document's words first. A null,
    empty or blank text has no runs and collapses to the empty text; rows with repeated or null
    ids are documents of their own; other columns of ``docs`` are not looked at. Texts of any
    length are read whole, one at a time in a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs = runs_of(texts, shortest)
            out = [collapsed(words, found) for words, found in zip(texts, runs)]
            rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
            columns = [pa.array(ids, pa.int64()), pa.array(rows, pa.list_(RUN)), pa.array(out, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

        for batch in batches:
            ids: list = []
            texts: list[list[bytes]] = []
            held = 0
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc, text = doc.as_py(), text.as_py()
                words = text.split() if text else []
                ids.append(doc)
                texts.append(prepare(doc, words) if prepare else words)
                held += len(words)
                if held >= BLOCK_WORDS:
                    yield batch_of(ids, texts)
                    ids, texts, held = [], [], 0
            yield batch_of(ids, texts)

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, FOUND)
