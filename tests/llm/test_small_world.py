"""Near-duplicate vectors through the graphs, in tasks that hold a bounded part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltgate.llm import small_world
from siltgate.llm.vectors import classes, unit_rows


def table_of(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id bigint, embedding array<float>")


def clustered(seed):
    """400 vectors alone, 300 pairs of near copies and a group of 150."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(701, 24))
    return np.concatenate([base, base[:300] + 0.05 * rng.normal(size=(300, 24)), base[700] + 0.05 * rng.normal(size=(149, 24))])


def test_a_graph_travels_as_rows_of_one_vector(spark):
    nodes = classes(table_of(spark, clustered(1)), "vec_id", "embedding").select("class", "vector")
    graphs = small_world._graphs(nodes, 2)
    assert graphs.count() == graphs.select("shard", "place").distinct().count() == 1_150
    assert graphs.agg(F.max(F.size("near"))).first()[0] <= 6 * small_world.DEGREE
    assert graphs.where("size(near) < 2 * 12 or exists(near, x -> x >= size)").count() == 0
    sizes = {r["shard"]: (r["size"], r["n"], r["last"]) for r in graphs.groupBy("shard", "size").agg(F.count("*").alias("n"), F.max("place").alias("last")).collect()}
    assert len(sizes) == 2 and all(size == n == last + 1 for size, n, last in sizes.values())


@pytest.mark.parametrize("query_rows", [100_000, 200])
def test_links_come_from_the_graphs(spark, monkeypatch, query_rows):
    monkeypatch.setattr(small_world, "QUERY_ROWS", query_rows)  # 1 and 6 parts of the vectors ask a graph
    monkeypatch.setattr(small_world, "SENT_PAIRS", 10)
    brute, steps = small_world._brute, []
    monkeypatch.setattr(small_world, "_brute", lambda *a: steps.append(brute(*a)) or steps[-1])
    monkeypatch.setattr(small_world, "AUDIT", 50)
    rows = clustered(2).astype(np.float32)
    got = {r["vec_id"]: r for r in small_world.near_duplicates(table_of(spark, rows)).collect()}
    assert len(steps) == 1 and steps[0] < small_world.PLACES  # only the audit compared with all rows
    unit = unit_rows(rows.astype(np.float64))
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.any(axis=1).sum() >= 500
    share = [min(got[i]["n_links"], n) / n for i, n in enumerate(near.sum(axis=1)) if n]
    assert np.mean(share) >= 0.98
    assert all(got[i]["n_links"] <= n for i, n in enumerate(near.sum(axis=1)))


def test_long_vectors_take_more_shards(spark, monkeypatch):
    monkeypatch.setattr(small_world, "AUDIT", 50)
    monkeypatch.setattr(small_world, "SHARD_BYTES", 1_150 * 24 * 8 // 10, raising=False)
    graphs, shards = small_world._graphs, []
    monkeypatch.setattr(small_world, "_graphs", lambda nodes, n: shards.append(n) or graphs(nodes, n))
    assert small_world.near_duplicates(table_of(spark, clustered(3))).count() == 1_150
    assert shards == [10]


def test_full_rows_of_links_keep_the_nearest_but_spread():
    rng = np.random.default_rng(4)
    rows = unit_rows(rng.normal(size=(600, 16)))
    graph = small_world.Graph(rows)
    for level, near in enumerate(graph.near):
        for a, held in enumerate(near):
            some = held[held >= 0]
            assert len(set(some.tolist())) == len(some) and a not in some
            assert (held[len(some):] == -1).all() and (graph.height[some] >= level).all()
    scores = rows @ rows.T
    want = {(i, int(j)) for i in range(600) for j in np.argsort(-scores[i])[:6]}
    found = set()
    for place, ids, near in graph.within(rows, -1.0, 64):
        order = np.argsort(-near, kind="stable")[:6]
        found |= {(place, int(j)) for j in ids[order]}
    assert len(want & found) >= 0.98 * len(want)
