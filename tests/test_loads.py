import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from siltgate.fixed_values import API, CSV, MONGO, TARGET_TABLES
from siltgate.operators.incremental import (
    advanced,
    filter_counts,
    id_text,
    keep_new,
    keep_new_by_source,
    next_checkpoint,
)
from siltgate.operators.keys import assign_keys, next_key
from siltgate.operators.prefix import running_total_before
from siltgate.operators.upsert import last_wins, new_records, payload_rows, skipped_records, upsert
from siltgate.plans.load import last_processed_id, load
from siltgate.sinks import jdbc
from siltgate.sinks.tables import TargetTable, create_statement, ensure_table, insert_rows, to_target


def ids(frame, column="id"):
    return sorted((r[column] for r in frame.collect()), key=str)


def text_ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_numeric_checkpoint_keeps_larger_null_and_words(spark):
    frame = text_ids(spark, "1", " 2 ", "3", "+10", "abc", None, "99999999999999999999")
    assert ids(keep_new(frame, "id", "2")) == sorted(["3", "+10", "abc", None, "99999999999999999999"], key=str)
    counts = filter_counts(frame, "id", "2").first()
    assert (counts["total_found"], counts["new"], counts["skipped"]) == (7, 5, 2)


def test_wide_checkpoint(spark):
    frame = text_ids(spark, "1", "99999999999999999999", "100000000000000000000")
    assert ids(keep_new(frame, "id", "99999999999999999999")) == ["100000000000000000000"]


def test_text_checkpoint_compares_text_and_keeps_numbers(spark):
    frame = text_ids(spark, "CSV00001", "CSV00003", "7", None)
    assert ids(keep_new(frame, "id", "CSV00002")) == sorted(["7", "CSV00003", None], key=str)
    assert keep_new(frame, "id", None).count() == 4


def test_integer_column_filter_reaches_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "ids"))
    frame = keep_new(spark.read.parquet(str(tmp_path / "ids")), "id", "40")
    assert frame.count() == 59
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,40)" in plan


def test_each_row_against_its_own_source(spark):
    marks = spark.sql("select * from values ('a', '2'), ('b', 'x5'), ('c', null) as t(source_name, last_processed_id)")
    rows = [("a", "1"), ("a", "3"), ("a", "w"), ("b", "x4"), ("b", "x6"), ("b", "7"), ("c", "1"), ("d", "1"), ("a", None)]
    text = keep_new_by_source(spark.createDataFrame(rows, "source_name string, id string"), marks, "id")
    assert {(r["source_name"], r["id"]) for r in text.collect()} == set(rows) - {("a", "1"), ("b", "x4")}
    numbers = [(s, int(i)) for s, i in rows if i and i.isdigit()]
    whole = keep_new_by_source(spark.createDataFrame(numbers, "source_name string, id long"), marks, "id")
    assert {(r["source_name"], r["id"]) for r in whole.collect()} == set(numbers) - {("a", 1)}


def test_derived_checkpoints_leave_the_rows_in_place(spark):
    marks = spark.range(3).selectExpr("concat('s', id) as source_name", "id").groupBy("source_name").agg(
        F.max("id").cast("string").alias("last_processed_id")
    )
    rows = spark.range(90).selectExpr("id", "concat('s', id % 3) as source_name")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = keep_new_by_source(rows, marks, "id")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 87
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_document_ids_as_text(documents, spark):
    frame = documents(5, 5.7, True, "x", None, [1]).withColumn("id", F.expr(id_text("document")))
    assert [r["id"] for r in frame.orderBy("pos").collect()] == ["5", "5", "1", "x", None, None]


def test_next_checkpoint(spark):
    def mark(*values):
        return next_checkpoint(text_ids(spark, *values), "id").first()["last_processed_id"]

    assert mark("1", "10", "9") == "10"
    assert mark("1", "10", "b") == "b"
    assert mark("5", "99999999999999999999") == "99999999999999999999"
    assert mark(None) is None
    by = spark.sql("select 'a' as s, '2' as id union all select 'a', '10' union all select 'b', 'x'")
    assert {r["s"]: r["last_processed_id"] for r in next_checkpoint(by, "id", "s").collect()} == {"a": "10", "b": "x"}


def test_checkpoint_never_moves_back(spark):
    cases = [("9", "10", "10"), ("10", "9", "10"), (None, "1", "1"), ("5", None, "5"), ("b", "a", "b"), ("5", "x", "x")]
    frame = spark.createDataFrame(cases, "o string, n string, wanted string")
    rows = frame.selectExpr(f"{advanced('o', 'n')} as got", "wanted").collect()
    assert all(r["got"] == r["wanted"] for r in rows)


def test_new_and_skipped_split_on_key_text(spark):
    batch = spark.sql("select * from values (1, 'a'), (2, 'b'), (null, 'c') as t(id, x)")
    target = spark.sql("select '1' as id union all select null")
    assert sorted(r["x"] for r in new_records(batch, target, "id").collect()) == ["b", "c"]
    assert [r["x"] for r in skipped_records(batch, target, "id").collect()] == ["a"]
    with pytest.raises(ValueError):
        new_records(batch, target, "other")


def test_last_wins_limits_rows_before_the_shuffle(spark):
    batch = spark.sql("select * from values (1, 1, 'a'), (1, 2, 'b'), (2, 1, 'c') as t(id, seq, x)")
    last = last_wins(batch, "id", ["seq"])
    assert sorted((r["id"], r["x"]) for r in last.collect()) == [(1, "b"), (2, "c")]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_upsert_overwrites_matches_and_keeps_columns_the_batch_lacks(spark):
    target = spark.sql("select * from values (1, 'a', 1.5D), (2, 'b', 2.5D) as t(id, x, y)")
    batch = spark.sql("select * from values (2, 'B', true), (3, null, false) as t(id, x, z)")
    rows = {r["id"]: (r["x"], r["y"], r["z"]) for r in upsert(target, batch, "id").collect()}
    assert rows == {1: ("a", 1.5, None), 2: ("B", 2.5, True), 3: (None, None, False)}


def test_payload_keeps_nulls(spark):
    row = payload_rows(spark.sql("select 1 as id, cast(null as string) as x"), "id", RUN_TS.isoformat()).first()
    assert row["payload"] == '{"id":1,"x":null}'


def test_running_total_matches_a_plain_sum(spark):
    rows = [(g, i, (i * 7 + g) % 5) for g in range(3) for i in range(50)]
    frame = spark.createDataFrame(rows, "g int, i long, n long")
    found = running_total_before(frame, ["g"], "i", "n", "before", chunk=8)
    assert found.count() == 150
    for r in found.collect():
        assert r["before"] == sum(n for g, i, n in rows if g == r["g"] and i < r["i"])


def test_assigned_keys_are_dense_and_ordered(spark):
    batch = spark.range(1000).selectExpr("(id * 37) % 1000 as x").repartition(7)
    existing = spark.sql("select 41 as k union all select 7")
    rows = sorted((r["x"], r["k"]) for r in assign_keys(batch, existing, "k", "x").collect())
    assert rows == [(i, 42 + i) for i in range(1000)]
    assert next_key(existing.limit(0), "k").first()["next_key"] == 1


def test_target_types_round_and_report_overflow(spark):
    frame = spark.sql("select 1 as product_id, 2.675D as price, 99.9D as rating, 'x' as extra")
    typed = to_target(frame, TARGET_TABLES["etl_api_products"][1])
    row = typed.rows.first()
    assert str(row["price"]) == "2.68" and row["fault"] == "rating does not fit decimal(3,2)" and row["extra"] == "x"
    assert typed.good.count() == 0 and typed.bad.count() == 1


def test_ensure_table_creates_and_adds_columns(spark):
    spark.sql("drop table if exists etl_csv_users")
    spark.sql("create table etl_csv_users (user_id string, full_name string) using parquet")
    spark.sql("insert into etl_csv_users values ('u', 'n')")
    ensure_table(spark, "etl_csv_users")
    row = spark.table("etl_csv_users").first()
    assert row["user_id"] == "u" and row["is_active"] is None and len(row) == 14
    ensure_table(spark, "etl_csv_users")
    spark.sql("drop table etl_csv_users")


def test_a_table_fills_the_load_time_it_is_not_given(spark):
    spark.sql("drop table if exists stamped_users")
    spark.sql(create_statement("etl_csv_users", as_name="stamped_users"))
    insert_rows(spark, "stamped_users", spark.sql("select 'a' as user_id, '7' as age, 'x' as unknown_column"))
    insert_rows(spark, "stamped_users", spark.sql("select 'b' as user_id, timestamp '2020-01-01 00:00:00' as updated_at"))
    rows = {r["user_id"]: r for r in spark.table("stamped_users").collect()}
    assert rows["a"]["age"] == 7 and rows["a"]["updated_at"] is not None and rows["a"]["full_name"] is None
    assert rows["b"]["updated_at"].year == 2020
    spark.sql("drop table stamped_users")


def users(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id string, full_name string, seq int").selectExpr(
        "named_struct('user_id', user_id, 'full_name', full_name, 'seq', seq) as canonical_record"
    )


@pytest.fixture
def tables(spark, tmp_path):
    return [TargetTable.named(spark, str(tmp_path), t) for t in ("etl_csv_users", "etl_metadata")]


def test_load_inserts_then_skips(spark, tables):
    target, marks = tables
    first = load(users(spark, ("1", "a", 1), ("2", "b", 1)), target, marks, "csv_users", RUN_TS, ["seq"])
    assert first == {"inserted": 2, "updated": 0, "skipped": 0}
    assert last_processed_id(marks.read(), "csv_users") == "2"
    again = load(users(spark, ("1", "z", 1), ("3", "c", 1), ("3", "d", 2)), target, marks, "csv_users", RUN_TS, ["seq"])
    assert again == {"inserted": 2, "updated": 0, "skipped": 1}
    assert {r["user_id"]: r["full_name"] for r in target.read().collect()} == {"1": "a", "2": "b", "3": "d"}
    assert last_processed_id(marks.read(), "csv_users") == "3"
    assert target.read().filter("updated_at is null").count() == 0


def test_load_upsert_mode_overwrites(spark, tables):
    target, marks = tables
    load(users(spark, ("1", "a", 1)), target, marks, "csv_users", RUN_TS, ["seq"])
    counts = load(users(spark, ("1", "z", 1), ("2", "b", 1)), target, marks, "csv_users", RUN_TS, ["seq"], mode="upsert")
    assert counts == {"inserted": 1, "updated": 1, "skipped": 0}
    assert {r["user_id"]: r["full_name"] for r in target.read().collect()} == {"1": "z", "2": "b"}


def test_empty_load_writes_nothing(spark, tables):
    target, marks = tables
    counts = load(users(spark, ("1", "a", 1)).limit(0), target, marks, "csv_users", RUN_TS, ["seq"])
    assert counts == {"inserted": 0, "updated": 0, "skipped": 0}
    assert marks.read().count() == 0 and last_processed_id(marks.read(), "csv_users") is None


def test_load_refuses_rows_without_key_or_fit(spark, tables):
    target, marks = tables
    with pytest.raises(ValueError, match="no user_id"):
        load(users(spark, (None, "a", 1)), target, marks, "csv_users", RUN_TS, ["seq"])
    with pytest.raises(ValueError, match="mode"):
        load(users(spark, ("1", "a", 1)), target, marks, "csv_users", RUN_TS, mode="merge")


def test_an_unfinished_version_is_not_read(spark, tables, tmp_path):
    target, marks = tables
    load(users(spark, ("1", "a", 1)), target, marks, "csv_users", RUN_TS, ["seq"])
    (tmp_path / "etl_csv_users" / "v000000002").mkdir()
    assert target.read().count() == 1
    target.replace(target.read())
    assert target.read().count() == 1


def test_old_versions_are_removed(spark, tables, tmp_path):
    target, _ = tables
    for i in range(4):
        former = target.read()
        target.replace(spark.sql(f"select 'u{i}' as user_id"))
        assert former.count() == min(i, 1)  # still there for its readers
    assert sorted(p.name for p in (tmp_path / "etl_csv_users").iterdir()) == ["v000000003", "v000000004"]
    assert target.read().first()["user_id"] == "u3"


def test_relational_statements():
    text = jdbc.postgres_upsert("t", "s", ["id", "a", "b"], "id")
    assert text == (
        'INSERT INTO t ("id", "a", "b") SELECT "id", "a", "b" FROM s'
        ' ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a", "b" = EXCLUDED."b"'
    )
    assert jdbc.postgres_upsert("t", "s", ["id"], "id").endswith("DO NOTHING")
    merge = jdbc.merge_upsert("t", "s", ["id", "a"], "id")
    assert 'WHEN MATCHED THEN UPDATE SET t."a" = s."a"' in merge and "WHEN NOT MATCHED THEN INSERT" in merge
    assert {CSV, API, MONGO} == {"csv", "api", "mongo"}
