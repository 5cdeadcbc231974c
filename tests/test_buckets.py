import os
from collections import defaultdict

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from siltgate.plans.load import load
from siltgate.sinks import buckets
from siltgate.sinks.buckets import BucketedTable
from siltgate.sinks.tables import TargetTable

SCHEMA = "id long, x string, y double"


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "t"), "id", SCHEMA, buckets=8)


def rows(spark, ids, x="a"):
    return spark.createDataFrame([(i, f"{x}{i}") for i in ids], "id long, x string")


def files(table):
    """Path and time of every data file, by bucket."""
    found = defaultdict(dict)
    for folder in table.folders():
        place = table.location(folder)
        for file in os.listdir(place):
            if file.endswith(".parquet"):
                path = os.path.join(place, file)
                found[folder.bucket][path] = os.stat(path).st_mtime_ns
    return found


def content(table):
    return {r["id"]: (r["x"], r["y"]) for r in table.read().collect()}


def test_upsert_rewrites_only_buckets_with_a_known_key(spark, table):
    first = table.upsert(rows(spark, range(400)).withColumn("y", F.lit(1.5)))
    assert (first.inserted, first.updated) == (400, 0)
    before = files(table)
    assert len(before) == 8
    written = table.upsert(rows(spark, [7, 1000], "b"))
    assert (written.inserted, written.updated) == (1, 1)
    bucket = {r["id"]: r["b"] for r in spark.createDataFrame([(7,), (1000,)], "id long").selectExpr("id", "pmod(hash(id), 8) as b").collect()}
    after = files(table)
    for b in before:
        if b == bucket[7]:
            assert not set(before[b]) & set(after[b])
        elif b == bucket[1000]:
            assert before[b].items() < after[b].items()  # one more folder
        else:
            assert before[b] == after[b]
    expected = {i: (f"a{i}", 1.5) for i in range(400)} | {7: ("b7", 1.5), 1000: ("b1000", None)}
    assert content(table) == expected


def test_insert_new_opens_only_folders_that_can_hold_a_key(spark, table):
    table.insert_new(rows(spark, range(0, 4000, 2)))
    # Past every range: nothing is opened.
    later = table.insert_new(rows(spark, range(10_000, 10_100)))
    assert (later.inserted, later.opened, later.skipped) == (100, 0, 8)
    # Inside the ranges, but in no sketch: at most a rare folder is opened in vain.
    between = table.insert_new(rows(spark, [11, 13, 15]))
    assert between.inserted == 3 and between.opened <= 1
    again = table.insert_new(rows(spark, [10, 11], "z"))
    assert (again.inserted, again.known) == (0, 2) and 2 <= again.opened <= 3
    assert content(table)[11] == ("a11", None) and table.read().count() == 2103


def test_loads_equal_a_plain_dictionary(spark, table, monkeypatch):
    monkeypatch.setattr(buckets, "FOLDERS", 2)
    plain = {}
    for step in range(6):
        ids = [(i * 37 + step * 11) % 90 for i in range(20)]
        ids = sorted(set(ids))
        over = step % 2 == 0
        written = (table.upsert if over else table.insert_new)(rows(spark, ids, f"s{step}-"))
        assert written.inserted == sum(i not in plain for i in ids)
        assert written.known == sum(i in plain for i in ids)
        for i in ids:
            if over or i not in plain:
                plain[i] = (f"s{step}-{i}", None)
        assert content(table) == plain
        by_bucket = defaultdict(int)
        for folder in table.folders():
            by_bucket[folder.bucket] += 1
        assert max(by_bucket.values()) <= 2


def test_old_folders_go_and_the_former_state_stays(spark, table):
    table.upsert(rows(spark, range(50)))
    for step in range(4):
        former = table.read()
        table.upsert(rows(spark, range(50), f"s{step}-"))
        assert former.count() == 50  # a frame made before the load still reads
    named = {f.write for f in table.folders()}
    kept = set(os.listdir(f"{table.path}/data"))
    assert named <= kept and len(kept) == 2
    assert len([n for n in os.listdir(f"{table.path}/manifests") if n.endswith(".json") and n[0] == "m"]) == 2


def test_a_load_that_fails_leaves_the_table(spark, table):
    table.upsert(rows(spark, range(20)))
    before = content(table)
    broken = rows(spark, [1]).withColumn("y", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception):
        table.upsert(broken)
    os.makedirs(f"{table.path}/data/left-behind/silt_bucket=1")
    assert content(table) == before
    table.upsert(rows(spark, [1], "b"))
    assert "left-behind" not in os.listdir(f"{table.path}/data")


def test_number_of_buckets_is_the_tables(spark, table):
    table.upsert(rows(spark, range(30)))
    other = BucketedTable(spark, table.path, "id", SCHEMA, buckets=3)
    assert other.buckets == 8
    other.upsert(rows(spark, range(30), "b"))
    assert content(table) == {i: (f"b{i}", None) for i in range(30)}


def test_empty_batch_and_text_keys(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "u"), "id", "id string, x string", buckets=4)
    assert table.read().count() == 0
    assert table.upsert(spark.createDataFrame([], "id string, x string")).inserted == 0
    text = spark.createDataFrame([("ä", "1"), ("b", "2"), ("", "3")], "id string, x string")
    assert table.insert_new(text).inserted == 3 and table.insert_new(text).known == 3
    assert {r["id"]: r["x"] for r in table.read().collect()} == {"ä": "1", "b": "2", "": "3"}


def test_a_load_shuffles_the_table_once(spark, table):
    table.upsert(rows(spark, range(100)))
    old = table._dealt(table.read())
    new = table._dealt(rows(spark, [1, 2]))
    plan = buckets.upsert(old, new, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("REPARTITION_BY_NUM") == 2


def test_load_into_buckets(spark, tmp_path):
    target = BucketedTable.named(spark, str(tmp_path), "etl_csv_users", buckets=4)
    marks = TargetTable.named(spark, str(tmp_path), "etl_metadata")

    def batch(*values):
        return spark.createDataFrame(list(values), "user_id string, full_name string, seq int").selectExpr(
            "named_struct('user_id', user_id, 'full_name', full_name, 'seq', seq) as canonical_record"
        )

    first = load(batch(("1", "a", 1), ("2", "b", 1), ("2", "c", 2)), target, marks, "csv_users", RUN_TS, ["seq"])
    assert first == {"inserted": 2, "updated": 0, "skipped": 0}
    again = load(batch(("1", "z", 1), ("3", "d", 1)), target, marks, "csv_users", RUN_TS, ["seq"])
    assert again == {"inserted": 1, "updated": 0, "skipped": 1}
    over = load(batch(("1", "z", 1), ("4", "e", 1)), target, marks, "csv_users", RUN_TS, ["seq"], mode="upsert")
    assert over == {"inserted": 1, "updated": 1, "skipped": 0}
    assert {r["user_id"]: r["full_name"] for r in target.read().collect()} == {"1": "z", "2": "c", "3": "d", "4": "e"}
    assert target.read().filter("updated_at is null").count() == 0
