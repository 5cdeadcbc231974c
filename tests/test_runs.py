import json

import pytest
from conftest import RUN_TS
from test_validate import DOCUMENT, PRODUCT, changed

from siltgate.plans.run import (
    API_PRODUCTS,
    CSV_USERS,
    DOCUMENT_USERS,
    Batch,
    accepted_per_source,
    merged,
    prepare,
    run_all,
    run_source,
)
from siltgate.sinks.tables import TargetTable
from siltgate.sources.csv_files import read_csv
from siltgate.streaming.landed import load_landed_documents

USERS = """user_id,full_name,email,phone,signup_date,country,age,status,newsletter_opt_in
CSV00001,Ann,a@b.c,,2024-01-05,X,33,active,Yes
CSV00002,Bob,,1,2024-01-05,X,,inactive,
CSV00003,Cy,c@d.e,2,2024-01-06,Y,-1,Pending,no
"""


def csv_batch(spark, tmp_path, text=USERS):
    folder = tmp_path / "csv"
    folder.mkdir(exist_ok=True)
    (folder / "users.csv").write_text(text)
    scan = read_csv(spark, str(folder), RUN_TS)
    return Batch(scan.rows, errors=scan.errors, order="row_number", null_is_missing=True)


def test_run_source_twice(spark, tmp_path):
    target = str(tmp_path / "out")
    first = run_source(spark, csv_batch(spark, tmp_path), CSV_USERS, target, RUN_TS)
    assert first.counts == {"inserted": 2, "updated": 0, "skipped": 0}
    assert [e["record_id"] for e in first.rejected.collect()] == ["CSV00002"]
    assert first.validation_summary.first()["accepted"] == 2
    table = TargetTable.named(spark, target, "etl_csv_users").read()
    rows = {r["user_id"]: r for r in table.collect()}
    assert rows["CSV00001"]["is_active"] and rows["CSV00003"]["age"] is None
    more = USERS + "CSV00004,Di,d@e.f,,2024-02-01,Z,40,active,\n"
    second = run_source(spark, csv_batch(spark, tmp_path, more), CSV_USERS, target, RUN_TS)
    assert second.counts == {"inserted": 1, "updated": 0, "skipped": 0}
    assert second.validation_summary.first()["processed"] == 1


def test_run_stops_at_source_errors(spark, tmp_path):
    batch = csv_batch(spark, tmp_path, USERS + "short\n")
    with pytest.raises(RuntimeError, match="reported errors"):
        run_source(spark, batch, CSV_USERS, str(tmp_path / "out"), RUN_TS)
    kept = run_source(spark, batch, CSV_USERS, str(tmp_path / "out"), RUN_TS, on_source_error="keep")
    assert kept.counts["inserted"] == 2


def test_strict_run_stops_at_unmappable_records(spark, tmp_path, documents):
    batch = Batch(documents(PRODUCT, changed(PRODUCT, id=2, tags=[1])), "document")
    with pytest.raises(RuntimeError, match="rejected records"):
        run_source(spark, batch, API_PRODUCTS, str(tmp_path / "out"), RUN_TS)
    result = run_source(spark, batch, API_PRODUCTS, str(tmp_path / "out"), RUN_TS, strict=False)
    assert result.counts["inserted"] == 1 and result.untransformed.count() == 1


def test_run_all_with_an_empty_source(spark, tmp_path, documents):
    batches = {
        "csv_users": csv_batch(spark, tmp_path),
        "api_products": Batch(documents(PRODUCT), "document"),
        "mongo_users": Batch(documents(DOCUMENT).limit(0), "document"),
    }
    results = run_all(spark, batches, str(tmp_path / "out"), RUN_TS)
    assert {n: r.counts["inserted"] for n, r in results.items()} == {
        "csv_users": 2, "api_products": 1, "mongo_users": 0,
    }
    marks = TargetTable.named(spark, str(tmp_path / "out"), "etl_metadata").read()
    assert {r["source_name"]: r["last_processed_id"] for r in marks.collect()} == {
        "csv_users": "CSV00003", "api_products": "1",
    }


def test_merged_frame_and_counts(spark, tmp_path, documents):
    ready = {
        "csv": prepare(csv_batch(spark, tmp_path), CSV_USERS, RUN_TS),
        "mongo": prepare(Batch(documents(DOCUMENT, changed(DOCUMENT, user_id=0)), "document"), DOCUMENT_USERS, RUN_TS),
    }
    assert sorted(r["source_type"] for r in merged(ready).select("source_type").collect()) == ["csv", "csv", "mongo"]
    assert {r["source_name"]: r["accepted"] for r in accepted_per_source(ready).collect()} == {"csv": 2, "mongo": 1}


def test_incremental_documents(spark, documents):
    batch = Batch(documents(*[changed(DOCUMENT, user_id=i) for i in (1, 2, 3)]), "document")
    ready = prepare(batch, DOCUMENT_USERS, RUN_TS, last_id="1")
    rows = ready.validation.accepted.select("record.user_id").collect()
    assert sorted(r["user_id"] for r in rows) == [2, 3]


def test_landed_files_load_once(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def deliver(name, *ids):
        lines = [json.dumps(changed(DOCUMENT, user_id=i)) for i in ids]
        (inbox / name).write_text("\n".join(lines) + "\n")

    def run():
        query = load_landed_documents(
            spark, str(inbox), DOCUMENT_USERS, out, str(tmp_path / "state"), clock=lambda: RUN_TS
        )
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r["user_id"] for r in TargetTable.named(spark, out, "etl_mongo_users").read().collect())

    deliver("a.json", 1, 2)
    assert run() == [1, 2]
    deliver("b.json", 2, 3)
    assert run() == [1, 2, 3]
