"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of vectors; every vector is filed in the leaf it descends
to. A query walks the tree with a priority queue over the branches it has not taken, nearest
centre first, and so ranks the leaves. How many leaves are visited is calibrated: for a sample of
queries the exact neighbours are computed against all rows, and visits widen until the wanted
share of them lies in the visited leaves.

Equal vectors are one class: of each only as many of the smallest ids as a result can need are
compared (one more than k, as the query itself may be among them), which loses nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.llm.common import stage
from siltgate.llm.vectors import classes, matrix, unit_rows

K = 5
SAMPLE = 10_000  # vectors the tree is fitted on
BRANCHES = 8
LEAF = 64  # sampled vectors a leaf holds at most
CALIBRATION = 128  # queries the number of visits is measured on
RECALL = 0.97
CHUNK = 4_096  # rows, and queries, compared at once


class Tree:
    """Centres by node; a node without children is a leaf."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 1):
        self.centres: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        random = np.random.default_rng(seed)
        todo = [(self._node(), sample)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf:
                continue
            centres, nearest = _kmeans(rows, branches, random)
            groups = [rows[nearest == i] for i in range(len(centres))]
            if max(map(len, groups)) == len(rows):
                continue  # all alike
            self.centres[node] = centres
            self.children[node] = [self._node() for _ in groups]
            todo += zip(self.children[node], groups)

    def _node(self) -> int:
        self.centres.append(None)
        self.children.append([])
        return len(self.children) - 1

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf each row descends to."""
        at = np.zeros(len(rows), dtype=np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            if not len(which) or not self.children[node]:
                at[which] = node
                continue
            nearest = (rows[which] @ self.centres[node].T).argmax(axis=1)
            todo += [(child, which[nearest == i]) for i, child in enumerate(self.children[node])]
        return at

    def leaves_by_nearness(self, row: np.ndarray, visits: int | None = None) -> list[int]:
        """The first ``visits`` leaves (all if None) in best-bin-first order."""
        queue, found = [(0.0, 0)], []
        while queue and (visits is None or len(found) < visits):
            _, node = heapq.heappop(queue)
            while self.children[node]:
                near = self.centres[node] @ row
                best = int(near.argmax())
                for i, child in enumerate(self.children[node]):
                    if i != best:
                        heapq.heappush(queue, (-float(near[i]), child))
                node = self.children[node][best]
            found.append(node)
        return found

    def leaves(self) -> int:
        return sum(not c for c in self.children)


def _kmeans(rows: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; empty groups go."""
    centres = rows[random.choice(len(rows), size=min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        used = np.unique(nearest)
        centres = np.stack([rows[nearest == i].sum(axis=0) for i in used])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres, (rows @ centres.T).argmax(axis=1)


def _top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, id, score) of the k best of each row of scores, the query's own id left out."""
    order = np.argsort(ids, kind="stable")
    scores, ids = scores[:, order], ids[order]
    scores = np.where(ids[None, :] == own[:, None], -np.inf, scores)
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # ties to the smaller id
    rows = np.repeat(np.arange(len(scores)), best.shape[1])
    found = scores[rows, best.ravel()]
    real = found > -np.inf
    return rows[real], ids[best.ravel()][real], found[real]


def nearest(
    vectors: DataFrame,
    queries: Callable[[str], F.Column] = lambda c: F.col(c) % 50 == 0,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
    sample: int = SAMPLE,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of every query, by cosine.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    rows with null ids. Ties go to the smaller id. A row repeated with the same id and vector is
    one candidate. With fewer than k candidates all are returned; a lone or empty table gives none.
    All vectors must have one width.
    """
    held = classes(vectors.where(F.col(id_col).isNotNull()), id_col, vector_col)
    by_class = Window.partitionBy("class").orderBy("id")
    rows = stage(
        held.dropDuplicates(["id", "class"])
        .withColumn("n", F.row_number().over(by_class))
        .where(F.col("n") <= k + 1)
        .drop("n"),
        "rows",
    )
    asked = stage(held.where(queries("id")).select("id", "vector").dropDuplicates(["id"]), "asked")
    # Bounded by ``sample`` and by CALIBRATION.
    fitted = rows.orderBy(F.xxhash64("id", "class")).limit(sample).select("vector").toPandas()
    if not len(fitted) or asked.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    tree = Tree(unit_rows(np.stack(fitted["vector"].to_numpy())))
    filed = stage(_filed(rows, tree), "filed")
    probes = asked.orderBy(F.xxhash64("id")).limit(CALIBRATION).toPandas()
    visits = _calibrated_visits(filed, tree, probes, k, recall)
    return _search(filed, asked, tree, visits, k)


def _filed(rows: DataFrame, tree: Tree) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf_of(unit_rows(matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], ["id", "vector", "leaf"])

    return rows.select("id", "vector").mapInArrow(run, "id bigint, vector array<double>, leaf bigint")


def _calibrated_visits(filed: DataFrame, tree: Tree, probes: pd.DataFrame, k: int, recall: float) -> int:
    """The fewest visits at which ``recall`` of the probes' exact neighbours lie in visited leaves."""
    ids = probes["id"].to_numpy()
    asked = unit_rows(np.stack(probes["vector"].to_numpy()))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).to_numpy()
                leaf = dict(zip(own.tolist(), batch.column(2).to_numpy().tolist()))
                place, found, score = _top(asked @ unit_rows(matrix(batch.column(1))).T, own, ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.array(found), pa.array(score), pa.array([leaf[i] for i in found.tolist()], pa.int64())],
                    ["place", "id", "score", "leaf"],
                )

    best = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    exact = (
        filed.select("id", "vector", "leaf")
        .mapInArrow(run, "place bigint, id bigint, score double, leaf bigint")
        .withColumn("n", F.row_number().over(best))
        .where(F.col("n") <= k)
        .select("place", "leaf")
        .collect()  # k rows a probe
    )
    ranks = [{leaf: i for i, leaf in enumerate(tree.leaves_by_nearness(row))} for row in asked]
    needed = sorted(ranks[r["place"]][r["leaf"]] + 1 for r in exact)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1


def _search(filed: DataFrame, asked: DataFrame, tree: Tree, visits: int, k: int) -> DataFrame:
    def probe(batches):
        for batch in batches:
            if batch.num_rows:
                found = [tree.leaves_by_nearness(row, visits) for row in unit_rows(matrix(batch.column(1)))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["id", "vector", "leaves"]
                )

    probes = asked.mapInArrow(probe, "id bigint, vector array<double>, leaves array<bigint>")
    # A leaf is compared in blocks of at most some CHUNK rows by CHUNK queries, whatever its size.
    sizes = filed.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).alias("row_blocks"))
    asked_leaf = probes.select("id", "vector", F.explode("leaves").alias("leaf"))
    asked_sizes = asked_leaf.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).alias("query_blocks"))
    blocks = F.broadcast(stage(sizes.join(asked_sizes, "leaf"), "blocks"))  # one row per leaf of the tree

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return (
            rows.join(blocks, "leaf")
            .withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"{own}s")))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}s") - 1)))
            .select("leaf", "row_block", "query_block", "id", "vector")
        )

    def compare(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(rows) or not len(queries):
            return pd.DataFrame({n: [] for n in names})
        across = unit_rows(np.stack(rows["vector"].to_numpy())).T
        found = []
        for at in range(0, len(queries), 512):
            part = queries.iloc[at : at + 512]
            own = part["id"].to_numpy()
            place, ids, score = _top(unit_rows(np.stack(part["vector"].to_numpy())) @ across, rows["id"].to_numpy(), own, k)
            found.append(pd.DataFrame({"query_id": own[place], "vec_id": ids, "score": score}))
        return pd.concat(found)

    keys = ["leaf", "row_block", "query_block"]
    compared = (
        dealt(filed, "row_block", "query_block")
        .groupBy(*keys)
        .cogroup(dealt(asked_leaf, "query_block", "row_block").groupBy(*keys))
        .applyInPandas(compare, "query_id bigint, vec_id bigint, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        compared.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
