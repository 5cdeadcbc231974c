import json
import threading
import time

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F
from test_runs import USERS
from test_validate import DOCUMENT, PRODUCT, changed

from siltgate.operators.responses import Paging
from siltgate.plans.extract import ApiLog, CsvFolder, DocumentExport
from siltgate.plans.run import API_PRODUCTS, DOCUMENT_USERS, Batch, RunFailed, run_all, run_source
from siltgate.sinks.buckets import BucketedTable
from siltgate.sinks.tables import TargetTable
from siltgate.sources.api import read_responses
from siltgate.sources.delivery import deliver
from siltgate.sources.documents import land_documents

LOG = "source string, page_index bigint, attempt int, status int, url string, body string"


def page(*ids, total=None):
    return json.dumps({"items": [{"id": i} for i in ids]} | ({"total": total} if total else {}))


def scan(spark, rows, **paging):
    log = spark.createDataFrame([(s, p, a, st, "u", b) for s, p, a, st, b in rows], LOG)
    return read_responses(log, Paging(**{"page_size": 2, "records_path": "items", **paging}))


def ids(frame):
    rows = frame.selectExpr("record_number", "variant_get(document, '$.id', 'bigint') as id").collect()
    return [r["id"] for r in sorted(rows, key=lambda r: r["record_number"])]


def test_records_after_retries_in_order(spark):
    found = scan(spark, [
        ("a", 0, 1, 503, "x"), ("a", 0, 2, 200, page(1, 2)), ("a", 1, 1, None, None), ("a", 1, 2, 429, "x"),
        ("a", 1, 3, 200, page(3, 4)), ("a", 2, 1, 200, page(5)), ("a", 3, 1, 200, page(6, 7)),
    ])
    assert ids(found.records) == [1, 2, 3, 4, 5] and found.error_count == 0
    assert [r["page"] for r in found.pages.orderBy("page").collect()] == [1, 2, 3]


@pytest.mark.parametrize(
    "second, error",
    [
        ([(1, 404, "gone")], "Non-success response status 404: gone"),
        ([(a, 503, "busy") for a in range(1, 5)] + [(5, 200, page(3))], "Non-success response status 503: busy"),
        ([(1, 200, '{"items": [')], "Response body is not valid JSON"),
        ([(1, 200, '{"other": []}')], "path 'items' not found in response payload."),
        ([], "an earlier page never landed."),
    ],
)
def test_a_failed_page_ends_its_walk_alone(spark, second, error):
    rows = [("a", 0, 1, 200, page(1, 2)), ("a", 2, 1, 200, page(5, 6)), ("b", 0, 1, 200, page(9))]
    rows += [("a", 1, *attempt) for attempt in second]
    found = scan(spark, rows)
    assert sorted(ids(found.records)) == [1, 2, 9] and (found.record_count, found.error_count) == (3, 1)
    assert found.errors.first()["error"] == error
    assert {r["source"]: r["error_count"] for r in found.summary.collect()} == {"a": 1, "b": 0}


def test_rejected_credentials_fail_the_run(spark):
    with pytest.raises(Exception, match="authentication failed"):
        scan(spark, [("a", 0, 1, 200, page(1, 2)), ("a", 1, 1, 401, "no")])


def test_offset_paging_ends_at_the_total(spark):
    rows = [("a", i, 1, 200, page(2 * i, 2 * i + 1, total=4)) for i in range(4)]
    found = scan(spark, rows, style="offset", start_page=0, total_path="total")
    assert ids(found.records) == [0, 1, 2, 3]


def test_api_records_past_the_checkpoint(spark):
    found = scan(spark, [("a", 0, 1, 200, page(1, 2)), ("a", 1, 1, 200, page(3)), ("b", 0, 1, 200, page(1))])
    marks = spark.createDataFrame([("a", "1")], "source_name string, last_processed_id string")
    assert sorted(ids(found.newer_than(marks))) == [1, 2, 3]


def test_an_empty_log(spark):
    found = read_responses(spark.createDataFrame([], LOG), Paging())
    assert found.records.count() == 0 and found.error_count == 0 and found.errors.count() == 0


# --- one pass ---------------------------------------------------------------------


@pytest.fixture
def watched(spark):
    """Lines whose every reading is counted."""

    def build(lines):
        readings = spark.sparkContext.accumulator(0)

        def look(batches):
            for batch in batches:
                readings.add(len(batch))
                yield batch

        frame = spark.createDataFrame([(x,) for x in lines], "value string")
        return frame.mapInPandas(look, "value string"), readings

    return build


def test_a_clean_source_is_scanned_once(spark, tmp_path, watched):
    lines, readings = watched([json.dumps(changed(DOCUMENT, user_id=i)) for i in range(1, 11)])

    class Watched:
        def extract(self, spark, run_ts):
            found = land_documents(lines, "value", "users", run_ts)
            return Batch(found.documents, "document", found.errors, error_count=found.error_count)

    result = run_source(spark, Watched(), DOCUMENT_USERS, str(tmp_path), RUN_TS)
    assert result.counts["inserted"] == 10 and result.rejected.count() == 0
    assert readings.value == 10


def test_a_failing_source_is_scanned_once_and_kept_on_demand(spark, tmp_path, watched):
    lines, readings = watched(["{broken", "[1]", json.dumps(DOCUMENT)])
    found = land_documents(lines, "value", "users", RUN_TS)
    batch = Batch(found.documents, "document", found.errors, error_count=found.error_count)
    with pytest.raises(RuntimeError, match="reported errors"):
        run_source(spark, batch, DOCUMENT_USERS, str(tmp_path), RUN_TS)
    kept = run_source(spark, batch, DOCUMENT_USERS, str(tmp_path), RUN_TS, on_source_error="keep")
    assert kept.counts["inserted"] == 1 and readings.value == 3 and found.error_count == 2
    assert sorted(r["error"] for r in found.errors.collect()) == ["not a document", "not valid JSON"]


def test_delivery_without_rows_or_without_errors(spark):
    none = deliver(spark.createDataFrame([], "x int"), "x < 0", "none")
    assert (none.record_count, none.error_count) == (0, 0) and none.errors.columns == ["x"]
    some = deliver(spark.range(5).withColumn("x", F.when(F.col("id") > 2, F.col("id"))), "x > 3", "some")
    assert (some.record_count, some.error_count) == (4, 1) and some.records.count() == 4


# --- sources side by side -----------------------------------------------------------


def landed(spark, tmp_path):
    csv, log, export = tmp_path / "csv", str(tmp_path / "log"), tmp_path / "export"
    csv.mkdir()
    (csv / "users.csv").write_text(USERS)
    body = json.dumps({"products": [changed(PRODUCT, id=i) for i in (1, 2)]})
    spark.createDataFrame([("products", 0, 1, 200, "u", body)], LOG).write.parquet(log)
    export.mkdir()
    (export / "users.json").write_text("\n".join(json.dumps(changed(DOCUMENT, user_id=i)) for i in (1, 2, 3)))
    return {
        "csv_users": CsvFolder(str(csv)),
        "api_products": ApiLog(log, Paging(page_size=30, records_path="products")),
        "mongo_users": DocumentExport(str(export), "users"),
    }


@pytest.mark.parametrize("buckets", [None, 4])
def test_all_sources_from_files_to_tables(spark, tmp_path, buckets):
    out = str(tmp_path / "out")
    for expected in ({"csv_users": 2, "api_products": 2, "mongo_users": 3}, {"csv_users": 0, "api_products": 0, "mongo_users": 0}):
        results = run_all(spark, landed(spark, tmp_path) if expected["csv_users"] else sources, out, RUN_TS, buckets=buckets)
        sources = {n: e for n, e in zip(("csv_users", "api_products", "mongo_users"), (
            CsvFolder(str(tmp_path / "csv")),
            ApiLog(str(tmp_path / "log"), Paging(page_size=30, records_path="products")),
            DocumentExport(str(tmp_path / "export"), "users"),
        ))}
        assert {n: r.counts["inserted"] for n, r in results.items()} == expected
    kind = BucketedTable if buckets else TargetTable
    assert kind.named(spark, out, "etl_api_products").read().count() == 2
    marks = TargetTable.named(spark, out, "etl_metadata").read()
    assert {r["source_name"] for r in marks.collect()} == {"csv_users", "api_products", "mongo_users"}


def test_sources_run_side_by_side_in_pools_of_their_own(spark, tmp_path, documents):
    together = threading.Barrier(2, timeout=60)
    pools = {}

    def source(name, frame):
        class Waiting:
            def extract(self, spark, run_ts):
                together.wait()  # passes only when both are being read
                pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
                return Batch(frame, "document")

        return Waiting()

    run_all(
        spark,
        {"api_products": source("api", documents(PRODUCT)), "mongo_users": source("mongo", documents(DOCUMENT))},
        str(tmp_path),
        RUN_TS,
    )
    assert pools == {"api": "api_products", "mongo": "mongo_users"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_one_failure_does_not_stop_the_others(spark, tmp_path, documents):
    class Broken:
        def extract(self, spark, run_ts):
            raise FileNotFoundError("no such export")

    class Slow:
        def extract(self, spark, run_ts):
            time.sleep(1)
            return Batch(documents(PRODUCT), "document")

    with pytest.raises(RunFailed, match="no such export") as ended:
        run_all(spark, {"mongo_users": Broken(), "api_products": Slow()}, str(tmp_path), RUN_TS)
    assert set(ended.value.failures) == {"mongo_users"}
    assert ended.value.results["api_products"].counts["inserted"] == 1
    assert TargetTable.named(spark, str(tmp_path), API_PRODUCTS.table).read().count() == 1


def test_staged_tables_are_removed_on_demand(tmp_path, spark):
    from siltgate.session import new_path, remove_staged, stage

    other = "/".join(new_path(spark, "x").split("/")[:-2]) + "/another-application/kept"
    spark.range(3).write.parquet(other)
    staged = stage(spark.range(5), "gone")
    assert staged.count() == 5
    remove_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(*staged.inputFiles()).count()
    assert spark.read.parquet(other).count() == 3
