import pytest
from pyspark.sql import functions as F

from siltgate.streaming.ledger import Ledger, load_stream, take_batch

ROWS = "source_name string, id string, x int"


@pytest.fixture
def ledger(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "ledger"))


@pytest.fixture
def sink():
    """Loaded rows, and how often each batch was loaded."""
    loaded, calls = [], []

    def load(rows, batch):
        calls.append(batch)
        loaded.extend((r["source_name"], r["id"]) for r in rows.collect())

    return load, loaded, calls


def rows(spark, *values):
    return spark.createDataFrame([(s, i, 0) for s, i in values], ROWS)


def test_late_rows_are_counted_and_left_out(spark, ledger, sink):
    load, loaded, _ = sink
    first = take_batch(rows(spark, ("a", "5"), ("a", "10"), ("b", "x2"), ("c", None)), 0, ledger, load)
    assert first.marks == {"a": "10", "b": "x2"} and first.late == {"a": 0, "b": 0, "c": 0}
    second = take_batch(rows(spark, ("a", "9"), ("a", "11"), ("b", "x1"), ("b", "x3"), ("d", "1"), ("c", None)), 1, ledger, load)
    assert second.rows == {"a": 2, "b": 2, "c": 1, "d": 1} and second.late == {"a": 1, "b": 1, "c": 0, "d": 0}
    assert second.marks == {"a": "11", "b": "x3", "d": "1"}
    assert ("a", "9") not in loaded and ("b", "x1") not in loaded and len(loaded) == 8


def test_a_replayed_batch_loads_nothing_twice(spark, ledger, sink):
    load, loaded, calls = sink
    batch = rows(spark, ("a", "1"), ("a", "2"))
    first = take_batch(batch, 0, ledger, load)
    assert take_batch(batch, 0, ledger, load) == first and calls == [0] and len(loaded) == 2


def test_a_batch_that_failed_starts_from_the_same_marks(spark, ledger, sink):
    load, loaded, _ = sink
    take_batch(rows(spark, ("a", "5")), 0, ledger, load)

    def fail(rows, batch):
        load(rows, batch)
        raise OSError("lost")

    again = rows(spark, ("a", "4"), ("a", "6"))
    with pytest.raises(OSError):
        take_batch(again, 1, ledger, fail)
    assert ledger.batches() == [0]
    entry = take_batch(again, 1, ledger, load)
    assert entry.late == {"a": 1} and entry.marks == {"a": "6"}
    assert loaded == [("a", "5"), ("a", "6"), ("a", "6")]  # which a keyed load writes once


def test_an_empty_batch_and_one_of_late_rows_alone(spark, ledger, sink):
    load, _, calls = sink
    assert take_batch(rows(spark), 0, ledger, load).marks == {} and calls == []
    take_batch(rows(spark, ("a", "5")), 1, ledger, load)
    late = take_batch(rows(spark, ("a", "5"), ("a", "1")), 2, ledger, load)
    assert late.late == {"a": 2} and late.marks == {"a": "5"} and calls == [1]


def test_stream_runs_from_where_it_stopped(spark, tmp_path, ledger, sink):
    load, loaded, _ = sink
    inbox = str(tmp_path / "in")
    for wave, ids in enumerate([("1", "3"), ("2", "4")]):
        rows(spark, *[("a", i) for i in ids]).coalesce(1).write.mode("append").parquet(inbox)
        query = load_stream(spark.readStream.schema(ROWS).parquet(inbox), ledger, load, str(tmp_path / "state"))
        query.awaitTermination(120)
        assert query.exception() is None and ledger.batches() == list(range(wave + 1))
    assert sorted(loaded) == [("a", "1"), ("a", "3"), ("a", "4")] and ledger.entry(1).late == {"a": 1}


def test_columns_with_names_of_ours(spark, ledger, sink):
    seen = []
    frame = rows(spark, ("a", "1")).withColumn("_new", F.lit(5)).withColumn("_mark", F.lit("m")).withColumn("found", F.lit("f"))
    take_batch(frame, 0, ledger, lambda new, batch: seen.extend(new.collect()))
    assert seen[0].asDict() == {"source_name": "a", "id": "1", "x": 0, "_new": 5, "_mark": "m", "found": "f"}
