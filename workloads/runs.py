"""Whole runs: single sources, the merged flow, routing."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltgate.operators.canonical import route
from siltgate.operators.responses import Paging
from siltgate.plans.extract import ApiLog, CsvFolder, DocumentExport
from siltgate.plans.run import (
    API_PRODUCTS,
    CSV_USERS,
    DOCUMENT_USERS,
    Extractor,
    Prepared,
    RunFailed,
    accepted_per_source,
    merged,
    prepare,
    run_all,
    run_source,
)
from siltgate.session import new_path
from siltgate.sinks.tables import TargetTable
from workloads import documents, products, users
from workloads.files import write_users
from workloads.inputs import DOCUMENTS, PAGE_SIZE, PRODUCT_LOG, USERS, land_files
from workloads.registry import RUN_TS, query

PRODUCT_PAGING = Paging("offset", start_page=0, page_size=PAGE_SIZE, records_path="products")


def extractors(spark: SparkSession, sf_dir: str) -> dict[str, Extractor]:
    """A CSV folder, an API's response log and a document export, derived from the tables."""
    users_folder = land_files(spark, sf_dir, "csv-users", write_users, USERS, "customer", "nation")
    log = land_files(spark, sf_dir, "product-log", lambda rows, path: rows.write.parquet(path), PRODUCT_LOG, "part")
    export = land_files(
        spark, sf_dir, "export", lambda rows, path: rows.select("line").write.text(path), DOCUMENTS, "customer", "nation"
    )
    return {
        "csv_users": CsvFolder(users_folder),
        "api_products": ApiLog(log, PRODUCT_PAGING),
        "mongo_users": DocumentExport(export, documents.COLLECTION),
    }


# Products whose tags cannot be joined are untransformable rejects.
PRODUCT_GOOD = "tags is distinct from '[\"a\", 3]'"
MERGED_SQL = f"""
select 'csv' as source_type, 'unknown' as source_name, rid as record_id, trim(full_name) as label, mail as email
  from ({users.EXPECTED} select rid, full_name, mail from outcome where n_errors = 0) u
union all select 'api', 'api_source', cast(clean_id as varchar), title_text, null
  from ({products.EXPECTED} select clean_id, title_text from good where {PRODUCT_GOOD}) p
union all select 'mongo', 'unknown', rid, full_name, clean_mail
  from ({documents.EXPECTED} select rid, concat(trim({documents._text('first_name')}), ' ', {documents._text('last_name')})
    as full_name, clean_mail from good) d
"""


def prepared(spark: SparkSession, sf_dir: str) -> dict[str, Prepared]:
    found = extractors(spark, sf_dir)
    return {
        s.source_type: prepare(found[s.name].extract(spark, RUN_TS), s, RUN_TS)
        for s in (CSV_USERS, API_PRODUCTS, DOCUMENT_USERS)
    }


@query("run_all_sources", MERGED_SQL)
def run_all_sources(spark, sf_dir):
    return merged(prepared(spark, sf_dir)).selectExpr(
        "source_type",
        "source_name",
        "record_id",
        "coalesce(csv_record.full_name, api_record.title, mongo_record.full_name) as label",
        "coalesce(csv_record.email, mongo_record.email) as email",
    )


@query("route_counts", f"select source_type, count(*) as n from ({MERGED_SQL}) m group by source_type")
def route_counts(spark, sf_dir):
    together = merged(prepared(spark, sf_dir))
    routed = [
        route(together, t).groupBy("source_type").agg(F.count("canonical_record").alias("n"))
        for t in ("csv", "api", "mongo")
    ]
    return routed[0].unionAll(routed[1]).unionAll(routed[2])


@query(
    "canonical_union",
    f"select source_type, count(*) as n, count(distinct record_id) as n_ids from ({MERGED_SQL}) m group by source_type",
)
def canonical_union(spark, sf_dir):
    together = merged(prepared(spark, sf_dir))
    return together.groupBy("source_type").agg(
        F.count("*").alias("n"), F.countDistinct("record_id").alias("n_ids")
    )


@query(
    "accepted_per_source",
    f"""select 'csv' as source_name, (select count(*) from ({users.EXPECTED} select 1 from outcome where n_errors = 0) u) as accepted
      union all select 'api', (select count(*) from ({products.EXPECTED} select 1 from good) p)
      union all select 'mongo', (select count(*) from ({documents.EXPECTED} select 1 from good) d)""",
)
def accepted_counts(spark, sf_dir):
    return accepted_per_source(prepared(spark, sf_dir))


CSV_GOOD = f"""{users.EXPECTED} select trim(user_id) as user_id, full_name, mail as email, clean_age as age, state as status,
  state = 'active' as is_active from outcome where n_errors = 0"""


@query(
    "run_csv_users",
    f"""select *, timestamp '2024-06-01 12:00:00' as updated_at, (select count(*) from ({CSV_GOOD}) n) as inserted,
      (select count(*) from customer) - (select count(*) from ({CSV_GOOD}) n) as rejected from ({CSV_GOOD}) good""",
)
def run_csv_users(spark, sf_dir):
    """From CSV files to the loaded table, with the load time and what the run counted."""
    folder = new_path(spark, "warehouse")
    result = run_source(spark, extractors(spark, sf_dir)["csv_users"], CSV_USERS, folder, RUN_TS)
    rejected = result.validation_summary.first()["rejected_records"]
    return TargetTable.named(spark, folder, CSV_USERS.table).read().selectExpr(
        "user_id", "full_name", "email", "age", "status", "is_active", "updated_at",
        f"{result.counts['inserted']}L as inserted", f"{rejected}L as rejected",
    )


@query(
    "source_error_policies",
    f"""select 'fail' as policy, 'failed' as outcome, 0::bigint as loaded, 0::bigint as others_loaded
      union all select 'keep', 'loaded', (select count(distinct k) from (select case when record_id = 'True' then 1
        else cast(regexp_replace(record_id, '[.]0$', '') as bigint) end as k from ({MERGED_SQL}) m where source_type = 'mongo') d), 0
      union all select 'fail beside another', 'failed', 0, (select count(*) from ({CSV_GOOD}) n)""",
)
def source_error_policies(spark, sf_dir):
    """A document export with unreadable lines: its run fails or keeps the rest; other sources load."""
    found = extractors(spark, sf_dir)

    def run(policy: str, *names: str):
        folder = new_path(spark, "warehouse")
        try:
            run_all(spark, {n: found[n] for n in names}, folder, RUN_TS, on_source_error=policy, strict=False)
            outcome = "loaded"
        except RunFailed:
            outcome = "failed"
        loaded, others = (TargetTable.named(spark, folder, t).read().count() for t in ("etl_mongo_users", "etl_csv_users"))
        return outcome, loaded, others

    rows = [("fail", *run("fail", "mongo_users")), ("keep", *run("keep", "mongo_users"))]
    rows.append(("fail beside another", *run("fail", "mongo_users", "csv_users")))
    return spark.createDataFrame(rows, "policy string, outcome string, loaded bigint, others_loaded bigint")


@query(
    "loaded_tables",
    f"""select 'etl_csv_users' as table_name, count(*) as n, max(record_id) as last_processed_id from ({MERGED_SQL}) m where source_type = 'csv'
      union all select 'etl_api_products', count(*), cast(max(cast(record_id as bigint)) as varchar) from ({MERGED_SQL}) m where source_type = 'api'
      union all select 'etl_mongo_users', count(distinct k), cast(max(k) as varchar) from (select case when record_id = 'True' then 1
        else cast(regexp_replace(record_id, '[.]0$', '') as bigint) end as k from ({MERGED_SQL}) m where source_type = 'mongo') d""",
)
def loaded_tables(spark, sf_dir):
    """Load all sources twice; the second run finds nothing new."""
    folder = new_path(spark, "warehouse")
    for _ in range(2):
        run_all(spark, extractors(spark, sf_dir), folder, RUN_TS, on_source_error="keep", strict=False)
    marks = TargetTable.named(spark, folder, "etl_metadata").read()
    tables = None
    for s in (CSV_USERS, API_PRODUCTS, DOCUMENT_USERS):
        rows = TargetTable.named(spark, folder, s.table).read()
        rows = rows.selectExpr(f"'{s.table}' as table_name", f"'{s.name}' as source_name")
        tables = rows if tables is None else tables.unionAll(rows)
    counts = tables.groupBy("table_name", "source_name").agg(F.count("*").alias("n"))
    return counts.join(marks, "source_name").select("table_name", "n", "last_processed_id")
