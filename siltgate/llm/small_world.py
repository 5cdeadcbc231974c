"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Every shard's vectors get a graph of several layers; every vector queries every shard. A query's
beam widens while all of it lies above the threshold, so large groups of copies are found whole;
and all beams widen, doubling, until the audit passes: for a sample of vectors that have links, the
links found are compared with those of a brute-force pass over all rows, vector by vector. If the
widest beam fails, the pass goes on over the rest, and its links are the answer. Links are verified
by cosine in double precision; components come from distributed star contraction.

Equal vectors are one class with a count and its smallest id, and one node of a graph.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import shared_folder, stage
from siltgate.llm.graph import components
from siltgate.llm.vectors import classes, matrix, unit_rows, usable

THRESHOLD = 0.9
SHARDS = 8
SHARD_ROWS = 100_000  # more vectors take more shards, so a graph fits a task,
SHARD_BYTES = 64_000_000  # and so do longer ones
DEGREE = 12
BUILD_BEAM = 48
BEAM = 16
WIDEST = 4_096
QUERY_ROWS = 100_000  # vectors that ask a graph in one task, which reads them in batches
SENT_ROWS = 4_000  # vectors of a graph in a batch
SENT_PAIRS = 100_000  # pairs in a batch, but for those of one vector
AUDIT = 200  # linked vectors the recall is measured on
FEW = 10  # vectors with no more links are measured on their own too, as a large group outnumbers them
AUDIT_ROWS = 400  # vectors compared with all rows in the first step of the audit
MOST_ROWS = 4_000  # and at most in a later one
RECALL = 0.98
BLOCK = 256  # vectors inserted, or queries run, at once
PRODUCTS = 1_000_000  # numbers held at once where full rows of links are cut


def _no_links(n: int, degree: int = DEGREE) -> list[np.ndarray]:
    """Rows for the links of n vectors in each layer, -1 where there is none."""
    return [np.full((n, 2 * degree if level == 0 else degree), -1, dtype=np.int32) for level in range(5)]


class Graph:
    """A navigable small-world graph; inserts and searches run in blocks.

    Layer l holds a share of DEGREE^-l of the vectors. A block of new vectors searches the graph
    as it is, and its members also see each other, so nothing depends on their order alone.
    """

    def __init__(self, rows: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 5):
        self.rows, self.single = rows, rows.astype(np.float32)  # the single ones lead the search
        n = len(rows)
        draws = np.random.default_rng(seed).random(n)
        self.height = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(degree)).astype(int), 4)
        self.height[0] = 4  # the entry point
        self.near = _no_links(n, degree)
        self.marks = np.zeros(0, dtype=bool)
        for start in range(0, n, BLOCK):
            self._insert(np.arange(start, min(start + BLOCK, n)), beam)

    @classmethod
    def restored(cls, rows: np.ndarray, near: list[np.ndarray]) -> Graph:
        graph = cls.__new__(cls)
        graph.rows, graph.single, graph.near, graph.marks = rows, rows.astype(np.float32), near, np.zeros(0, dtype=bool)
        return graph

    def lists(self, start: int, end: int) -> pa.Array:
        """The links of some vectors, a list each: those of layer 0, then of every layer the vector is in."""
        widths = np.array([near.shape[1] for near in self.near]).cumsum()[self.height[start:end]]
        links = np.concatenate([near[start:end] for near in self.near], axis=1)
        values = links[np.arange(links.shape[1]) < widths[:, None]]
        return pa.ListArray.from_arrays(pa.array(np.append(0, widths.cumsum()), pa.int32()), pa.array(values, pa.int32()))

    def _insert(self, new: np.ndarray, beam: int) -> None:
        first = int(new[0])
        entry = np.zeros(len(new), dtype=np.int64)
        among = self.single[new] @ self.single[new].T
        for level in range(4, -1, -1):
            if first:
                found, scores = self._beam(self.rows[new], entry, level, beam if level < 4 else 8)
                entry = found[:, 0].copy()
            else:
                found, scores = np.full((len(new), 0), -1), np.full((len(new), 0), -np.inf)
            here = self.height[new] >= level
            if not here.any():
                continue
            ids = np.concatenate([found, np.tile(new, (len(new), 1))], axis=1)
            near = np.concatenate([scores, np.where(here[None, :], among, -np.inf)], axis=1)
            near[ids == new[:, None]] = -np.inf
            width = self.near[level].shape[1]
            order = np.argsort(-near, axis=1, kind="stable")[:, : width // 2 if level == 0 else width]
            chosen = np.take_along_axis(ids, order, 1)
            chosen[~np.isfinite(np.take_along_axis(near, order, 1))] = -1
            own, place = np.nonzero((chosen >= 0) & here[:, None])
            self._link(level, new[own], chosen[own, place])

    def _link(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        """Link every a with the b beside it, both ways; a full row keeps its best."""
        n, links = len(self.rows), self.near[level]
        a, b = np.divmod(np.unique(np.concatenate([a * n + b, b * n + a])), n)
        fresh = ~(links[a] == b[:, None]).any(axis=1)
        a, b = a[fresh], b[fresh]
        nodes, start, more = np.unique(a, return_index=True, return_counts=True)
        held = (links[nodes] >= 0).sum(axis=1)
        group = np.repeat(np.arange(len(nodes)), more)
        rank = np.arange(len(a)) - start[group]
        fits = (held + more <= links.shape[1])[group]
        links[a[fits], (held[group] + rank)[fits]] = b[fits]
        full = np.flatnonzero(held + more > links.shape[1])
        full = full[np.argsort(more[full], kind="stable")]
        at = 0
        while at < len(full):
            # Of as many rows at once as bound the products; the last of them has the most new links.
            part = full[at : at + 1_024]
            size = links.shape[1] + more[part]
            part = part[: max(1, int((np.arange(1, len(part) + 1) * size * (size + self.rows.shape[1]) <= PRODUCTS).sum()))]
            at += len(part)
            pool = np.full((len(part), links.shape[1] + more[part[-1]]), -1, dtype=np.int64)
            pool[:, : links.shape[1]] = links[nodes[part]]
            own = np.repeat(np.arange(len(part)), more[part])
            late = np.arange(len(own)) - np.repeat(np.cumsum(more[part]) - more[part], more[part])
            pool[own, links.shape[1] + late] = b[start[part][own] + late]
            links[nodes[part]] = self._best(nodes[part], pool, links.shape[1])

    def _best(self, nodes: np.ndarray, pool: np.ndarray, width: int) -> np.ndarray:
        """The nearest of each pool, but spread: a neighbour closer to a nearer one than to the node goes first."""
        vectors = self.single[pool]
        near = np.matmul(vectors, self.single[nodes][:, :, None])[:, :, 0]
        near[pool < 0] = -np.inf
        among = np.matmul(vectors, vectors.transpose(0, 2, 1))
        covered = ((among > near[:, :, None]) & (near[:, None, :] > near[:, :, None])).any(axis=2)
        # Cosines differ by 2 at most, so what is covered ranks behind all that is not.
        return np.take_along_axis(pool, np.argsort(-np.where(covered, near - 4, near), axis=1, kind="stable")[:, :width], 1)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` nodes and scores reached in a layer from ``entry``, best first; -1 pads."""
        q, n, links = len(queries), len(self.rows), self.near[level]
        if len(self.marks) < q * n:
            self.marks = np.zeros(q * n, dtype=bool)
        seen = self.marks  # all false between searches: what a search marked is cleared at its end
        ids, scores = np.full((q, beam), -1, dtype=np.int64), np.full((q, beam), -np.inf, dtype=np.float32)
        # Of the queries that go on: their places, beams and scores. A beam holds twice a node, and one more
        # where it was opened, so -1 is an opened pad.
        who, asked = np.arange(q), queries.astype(np.float32)
        beams, near = ids.copy(), scores.copy()
        beams[:, 0], near[:, 0] = 2 * entry, np.einsum("ij,ij->i", asked, self.single[entry])
        marked = [who * n + entry]
        seen[marked[0]] = True
        while True:
            waiting = np.where(beams & 1, -np.inf, near)
            best = waiting.argmax(axis=1)
            going = waiting[np.arange(len(who)), best] > -np.inf
            if not going.all():
                ids[who[~going]], scores[who[~going]] = beams[~going] >> 1, near[~going]
                who, asked, beams, near, best = who[going], asked[going], beams[going], near[going], best[going]
                if not len(who):
                    break
            every = np.arange(len(who))
            around = links.take(beams[every, best] >> 1, axis=0).astype(np.int64)
            beams[every, best] |= 1
            flat = around + (who * n)[:, None]
            place = np.flatnonzero((around >= 0) & ~seen.take(flat, mode="clip"))
            if not len(place):
                continue
            marked.append(flat.ravel()[place])
            seen[marked[-1]] = True
            node = around.ravel()[place]
            found, new = np.full(around.shape, -1, dtype=np.int64), np.full(around.shape, -np.inf, dtype=np.float32)
            found.ravel()[place] = 2 * node
            asking = asked.take(place // around.shape[1], axis=0)
            new.ravel()[place] = np.einsum("ij,ij->i", asking, self.single.take(node, axis=0))
            near, beams = np.concatenate([near, new], axis=1), np.concatenate([beams, found], axis=1)
            keep = np.argpartition(-near, beam - 1, axis=1)[:, :beam] + (every * near.shape[1])[:, None]
            near, beams = near.take(keep), beams.take(keep)
        seen[np.concatenate(marked)] = False
        order = np.argsort(-scores, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)

    def within(self, queries: np.ndarray, threshold: float, beam: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query place, nodes, scores) of what is found at or above the threshold.

        Queries whose whole beam lies above it are asked again with a beam four times as wide.
        """
        for start in range(0, len(queries), BLOCK):
            todo, width = np.arange(start, min(start + BLOCK, len(queries))), beam
            while len(todo):
                step = max(1, min(BLOCK, 16_000_000 // (len(self.rows) + 8 * width)))
                again = []
                for at in range(0, len(todo), step):
                    part = todo[at : at + step]
                    entry = np.zeros(len(part), dtype=np.int64)
                    for level in range(4, 0, -1):
                        found, _ = self._beam(queries[part], entry, level, 1)
                        entry = found[:, 0]
                    ids, scores = self._beam(queries[part], entry, 0, width)
                    for place, found, near in zip(part.tolist(), ids, scores):
                        hit = near >= threshold
                        if hit.all() and width < len(self.rows):
                            again.append(place)
                        elif hit.any():
                            yield place, found[hit], near[hit]
                todo, width = np.array(again, dtype=np.int64), width * 4


# Searches score in single precision; candidates a hair below the threshold are checked too.
_SLACK = 1e-5


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other vectors linked directly (cosine at or above the threshold),
    ``component_id`` is the smallest id reachable, and ``kept`` says whether that is the row's
    own. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. Rows repeated with one id and vector are vectors of their own that link. A null id
    is counted by others but names no component. Empty tables give no rows.
    """
    held = classes(vectors, id_col, vector_col)
    grouped = stage(
        held.groupBy("class").agg(F.first("vector").alias("vector"), F.min("id").alias("least"), F.count("*").alias("n")),
        "classes",
    )
    nodes = grouped.select("class", "vector")
    count, width = nodes.agg(F.count("*"), F.max(F.size("vector"))).first()
    shards = max(SHARDS, -(-count // SHARD_ROWS), -(-count * (width or 0) * 8 // SHARD_BYTES))
    pairs = _audited_pairs(nodes, shards, threshold, recall) if count > 1 else None
    if pairs is None:
        linked = grouped.select("class", "n", "least", F.lit(0).alias("others"), F.col("class").alias("root"))
    else:
        # Every pair is found from either end or from both.
        both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        sizes = grouped.select(F.col("class").alias("b"), "n")
        others = both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("others"))
        roots = components(pairs)
        linked = (
            grouped.join(others.withColumnRenamed("a", "class"), "class", "left")
            .join(roots.withColumnRenamed("node", "class"), "class", "left")
            .select("class", "n", "least", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("root", "class").alias("root"))
        )
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    found = linked.join(least, "root").select("class", (F.col("others") + F.col("n") - 1).alias("n_links"), "component_id")
    placed = held.select("id", "class").join(found, "class").select("id", "n_links", "component_id")
    rest = vectors.where(~usable(vector_col)).select(
        F.col(id_col).alias("id"), F.lit(0).cast("bigint").alias("n_links"), F.col(id_col).alias("component_id")
    )
    return placed.unionAll(rest).select(
        F.col("id").alias("vec_id"),
        F.col("n_links").cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _audited_pairs(nodes: DataFrame, shards: int, threshold: float, recall: float) -> DataFrame:
    """Verified pairs (a, b), a < b, staged, at a beam whose recall on the audit passed; else all pairs."""
    links = f"{shared_folder(nodes.sparkSession)}/audit-{uuid.uuid4().hex}"
    count = nodes.count()
    done = _brute(nodes, count, threshold, links, 0, AUDIT)
    if done == PLACES:
        return _pairs_of(nodes.sparkSession.read.parquet(links))
    wanted = nodes.sparkSession.read.parquet(links)
    graphs = _graphs(nodes, shards)
    # A vector's search does not depend on the others, so those at either end of a link tell the recall of all.
    ends = wanted.select(F.explode(F.array("own", "other")).alias("class")).distinct()
    some = stage(nodes.join(ends, "class", "left_semi"), "audited")
    beam = BEAM
    while True:
        if _measured(wanted, stage(_pairs(some, some.count(), shards, threshold, beam, graphs), "audited-pairs")) >= recall:
            return stage(_pairs(nodes, count, shards, threshold, beam, graphs), "pairs")
        if beam >= WIDEST:
            break
        beam *= 2
    _brute(nodes, count, threshold, links, done, None)
    return _pairs_of(nodes.sparkSession.read.parquet(links))


def _pairs_of(links: DataFrame) -> DataFrame:
    return links.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).distinct()


def _measured(wanted: DataFrame, pairs: DataFrame) -> float:
    """The mean share of an audited vector's links that was found, or that of the vectors with few links if lower."""
    asked = wanted.withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})
    hits = asked.join(pairs, ["a", "b"], "left_semi").groupBy("own").agg(F.count("*").alias("hits"))
    share = asked.groupBy("own").agg(F.count("*").alias("n")).join(hits, "own", "left").withColumn(
        "share", F.coalesce("hits", F.lit(0)) / F.col("n")
    )
    return min(x for x in share.agg(F.avg("share"), F.avg(F.when(F.col("n") <= FEW, F.col("share")))).first() if x is not None)


PLACES = 1 << 31


def _brute(nodes: DataFrame, count: int, threshold: float, path: str, done: int, enough: int | None) -> int:
    """Append to ``path`` the links (own, other) of vectors compared with every row, from place ``done`` of a hashed order on.

    It ends after the step in which ``enough`` vectors with links were found, or with the last
    vector, and returns the place reached.
    """
    placed = nodes.withColumn("place", F.pmod(F.xxhash64("class", F.lit(3)), F.lit(PLACES)))
    rows_wanted = AUDIT_ROWS if enough else MOST_ROWS
    while done < PLACES:
        upto = min(PLACES, done + max(1, PLACES * rows_wanted // count))
        # Some MOST_ROWS vectors.
        sample = placed.where((F.col("place") >= done) & (F.col("place") < upto)).drop("place").toPandas()
        _links(nodes, sample, threshold).write.mode("append").parquet(path)
        done, rows_wanted = upto, min(2 * rows_wanted, MOST_ROWS)
        if enough and nodes.sparkSession.read.parquet(path).select("own").distinct().count() >= enough:
            break
    return done


def _links(nodes: DataFrame, sample: pd.DataFrame, threshold: float) -> DataFrame:
    """All links (own, other) of the sampled vectors, by comparing them with every row."""
    keys = sample["class"].to_numpy()
    rows = unit_rows(np.stack(sample["vector"].to_numpy())) if len(sample) else None

    def run(batches):
        for batch in batches:
            if batch.num_rows and rows is not None:
                every, others = unit_rows(matrix(batch.column(1))), batch.column(0).to_numpy()
                for start in range(0, len(every), 1_000):  # bounds the scores
                    at, place = np.nonzero(every[start : start + 1_000] @ rows.T >= threshold)
                    own, other = keys[place], others[start + at]
                    keep = own != other
                    yield pa.RecordBatch.from_arrays([pa.array(own[keep]), pa.array(other[keep])], ["own", "other"])

    return nodes.mapInArrow(run, "own bigint, other bigint")


def _pairs(asked: DataFrame, count: int, shards: int, threshold: float, beam: int, graphs: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of the ``count`` vectors ``asked`` and what they find in every shard's graph.

    A task reads one graph, row by row, and then its part of the vectors, batch by batch: it holds
    the graph and the links of some vectors, however many there are of either.
    """
    parts = max(1, -(-count // QUERY_ROWS))
    last = (1 << 31) - 1  # behind every place in a graph
    # Tasks shard * parts + part.
    tasks = F.sequence(F.col("shard") * parts, F.col("shard") * parts + parts - 1)
    held = graphs.select(F.explode(tasks).alias("task"), "place", "size", "class", "vector", "near")
    part = F.pmod(F.xxhash64("class", F.lit(13)), F.lit(parts)).cast("int")
    queries = asked.select(
        F.explode(F.sequence(part, part + (shards - 1) * parts, F.lit(parts))).alias("task"),
        F.lit(last).alias("place"),
        F.lit(0).alias("size"),
        "class",
        "vector",
        F.lit(None).cast("array<int>").alias("near"),
    )

    def search(batches):
        keys = rows = near = graph = None
        for batch in batches:
            place, size, own, vectors, lists = batch.columns[1:]
            held = int((place.to_numpy() < last).sum())
            if held:
                if keys is None:
                    n, width = size[0].as_py(), len(vectors[0])
                    keys, rows, near = np.zeros(n, dtype=np.int64), np.zeros((n, width)), _no_links(n)
                at = place.slice(0, held).to_numpy()
                keys[at], rows[at] = own.slice(0, held).to_numpy(), unit_rows(matrix(vectors.slice(0, held)))
                lengths = lists.slice(0, held).value_lengths().to_numpy()
                links = np.concatenate(_no_links(held), axis=1)
                links[np.arange(links.shape[1]) < lengths[:, None]] = lists.slice(0, held).flatten().to_numpy()
                for level, part in enumerate(np.split(links, (6 - np.arange(4, 0, -1)) * DEGREE, axis=1)):
                    near[level][at] = part
            if held < batch.num_rows and keys is not None:
                graph = graph or Graph.restored(rows, near)
                yield from found(keys, graph, own.slice(held).to_numpy(), unit_rows(matrix(vectors.slice(held))))

    def found(keys: np.ndarray, graph: Graph, own: np.ndarray, rows: np.ndarray):
        ends, waiting = ([], []), 0
        for place, ids, _ in graph.within(rows, threshold - _SLACK, beam):
            other = keys[ids[graph.rows[ids] @ rows[place] >= threshold]]
            other = other[other != own[place]]
            ends[0].append(np.minimum(other, own[place]))
            ends[1].append(np.maximum(other, own[place]))
            waiting += len(other)
            if waiting >= SENT_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ends], ["a", "b"])
                ends, waiting = ([], []), 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ends], ["a", "b"])

    return (
        held.unionAll(queries)
        .repartitionById(shards * parts, "task")
        .sortWithinPartitions("place")
        .mapInArrow(search, "a bigint, b bigint")
        .distinct()
    )


def _graphs(nodes: DataFrame, shards: int) -> DataFrame:
    """Staged rows, one a vector: its shard, the shard's size, its place there and the places it links with, layer by layer."""

    def build(batches):
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        graph = Graph(np.concatenate([unit_rows(matrix(b.column(2))) for b in read]))
        at = 0
        while read:
            batch = read.pop(0)
            for start in range(0, batch.num_rows, SENT_ROWS):
                some = batch.slice(start, SENT_ROWS)
                n = some.num_rows
                place = pa.array(np.arange(at, at + n), pa.int32())
                size = pa.array(np.full(n, len(graph.rows)), pa.int32())
                lists = graph.lists(at, at + n)
                yield pa.RecordBatch.from_arrays([some.column(0), place, size, *some.columns[1:], lists], names)
                at += n

    names = ["shard", "place", "size", "class", "vector", "near"]
    spread = nodes.select(F.pmod(F.xxhash64("class", F.lit(11)), F.lit(shards)).cast("int").alias("shard"), "class", "vector")
    return stage(
        spread.repartitionById(shards, "shard")
        .sortWithinPartitions("class")
        .mapInArrow(build, "shard int, place int, size int, class bigint, vector array<double>, near array<int>"),
        "graphs",
    )
