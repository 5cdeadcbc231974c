"""Landed API pages and response logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltgate.operators import responses as r
from siltgate.operators.responses import Paging
from siltgate.sources.api import ApiScan, read_responses
from workloads.inputs import API_LOG, API_PAGE, API_ROWS, LANDED, PAGE_FACTS, PAGE_SIZE, RESPONSES, land, sql
from workloads.registry import query

PAGING = Paging(
    "offset", start_page=0, page_size=PAGE_SIZE, max_pages=20, records_path="data.products", total_path="total"
)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.parse(land(spark, sf_dir, "pages", LANDED, "part"), PAGING)


# Per page: what it reads as, and whether the walk gets there.
EXPECTED = f"""
with facts as ({PAGE_FACTS}),
read as (
  select *, concat('https://example.org/', source, '?skip=', page_index * {PAGE_SIZE}) as url,
    case state when 'broken' then 'Response body is not valid JSON'
      when 'nopath' then 'path ''data.products'' not found in response payload.'
      when 'scalar' then 'Normalized response payload is neither a list nor an object.' end as error,
    case when state = 'fine' then n_items end as n_records,
    case when state = 'fine' then case total_json when '200' then 200 when '10000' then 10000 when 'true' then 1 end end as total
  from facts),
walk as (
  select *, error is not null or n_records < {PAGE_SIZE} or page_index >= 19
      or coalesce(sum(n_records) over (partition by source order by page_index) >= total, false) as stops
  from read),
reached as (
  select * from (select *, coalesce(bool_or(stops) over (partition by source order by page_index
    rows between unbounded preceding and 1 preceding), false) as past from walk) w where not past)
"""


@query("parse_pages", EXPECTED + "select source, page_index, n_records, error from read")
def parse_pages(spark, sf_dir):
    return parsed(spark, sf_dir).select("source", "page_index", "n_records", "error")


@query("page_totals", EXPECTED + "select source, page_index, total from read")
def page_totals(spark, sf_dir):
    return parsed(spark, sf_dir).select("source", "page_index", "total")


@query(
    "records_path",
    EXPECTED
    + f"""select r.source, r.page_index, p_partkey - (p_partkey // 700) * 700 - r.page_index * {PAGE_SIZE} as position,
      p_partkey as id from reached r join part on r.source_no = p_partkey // 700
      and r.page_index = (p_partkey % 700) // {PAGE_SIZE} where error is null""",
)
def records_path(spark, sf_dir):
    found = r.records(r.assemble(parsed(spark, sf_dir), PAGING))
    return found.selectExpr(
        "source", "page_index", "cast(position as bigint) as position", "variant_get(record, '$.id', 'bigint') as id"
    )


@query(
    "assemble_pages",
    EXPECTED + f"select source, page_index, page_index * {PAGE_SIZE} as page, n_records, error from reached",
)
def assemble_pages(spark, sf_dir):
    pages = r.assemble(parsed(spark, sf_dir), PAGING)
    return pages.select("source", "page_index", "page", "n_records", "error")


@query(
    "page_errors",
    EXPECTED + f"select source, page_index * {PAGE_SIZE} as page, 200 as status, error from reached where error is not null",
)
def page_errors(spark, sf_dir):
    return r.page_errors(r.assemble(parsed(spark, sf_dir), PAGING))


@query(
    "page_metadata",
    EXPECTED
    + f"""select source, page_index * {PAGE_SIZE} as page, 200 as status, url, n_records, total from reached
      where error is null""",
)
def page_metadata(spark, sf_dir):
    return r.page_metadata(r.assemble(parsed(spark, sf_dir), PAGING))


@query(
    "page_summary",
    EXPECTED
    + f"""select source, count(*) filter (error is null) as pages_fetched, coalesce(sum(n_records), 0)::bigint as record_count,
      count(*) filter (error is not null) as error_count, min(page_index * {PAGE_SIZE}) filter (error is null) as first_page,
      max(page_index * {PAGE_SIZE}) filter (error is null) as last_page from reached group by source""",
)
def page_summary(spark, sf_dir):
    return r.page_summary(r.assemble(parsed(spark, sf_dir), PAGING))


@query(
    "page_plan",
    EXPECTED
    + f"""select source, page_index, {PAGE_SIZE} * page_index as page_value, {PAGE_SIZE} as page_size from
      (select source, unnest(range(0, max(page_index) + 1)) as page_index from facts group by source) p""",
)
def page_plan(spark, sf_dir):
    return r.landed_requests(land(spark, sf_dir, "pages", LANDED, "part"), PAGING)


# --- attempts -------------------------------------------------------------------------

OUTCOME = """case when status in (401, 403) then 'auth_error' when status < 400 then 'success'
  when (status is null or status in (429, 500, 502, 503, 504)) and attempt <= 3 then 'retry' else 'error' end"""


@query(
    "classify_responses",
    f"""select source, page_index, attempt, status, {OUTCOME} as outcome,
      case when {OUTCOME} = 'retry' then pow(2, attempt - 1) end as delay_seconds from ({RESPONSES}) log""",
)
def classify_responses(spark, sf_dir):
    log = sql(spark, sf_dir, RESPONSES, "events").drop("body")
    return r.retry_delays(r.classify(log))


@query(
    "final_attempt",
    f"""with log as (select *, {OUTCOME} as outcome from ({RESPONSES}) l where attempt <= 4),
      ranked as (select *, row_number() over (partition by source, page_index
        order by outcome = 'retry', case when outcome = 'retry' then -attempt else attempt end) as rn from log)
      select source, page_index, attempt, status, outcome, pow(2, attempt - 1) - 1 as waited_seconds,
        case when outcome = 'auth_error' then concat('Authentication failed with status ', status, '.')
          when outcome = 'error' and status is null then concat('Request failed after ', attempt, ' attempt(s)')
          when outcome = 'error' then concat('Non-success response status ', status, ': ', substring(body, 1, 300)) end as error
      from ranked where rn = 1""",
)
def final_attempt(spark, sf_dir):
    return r.final_attempts(sql(spark, sf_dir, RESPONSES, "events")).drop("body")


# --- an API read from its log --------------------------------------------------------

API_PAGING = Paging("offset", start_page=0, page_size=API_PAGE, records_path="data.products", total_path="total")


def api_scan(spark: SparkSession, sf_dir: str) -> ApiScan:
    return read_responses(land(spark, sf_dir, "api-log", API_LOG, "part"), API_PAGING)


# The first page each kind of API does not give records for, and why.
API_END = "case kind when 1 then 5 when 2 then 4 when 3 then 6 when 4 then 3 when 5 then 4 else 1000 end"
API_ERROR = """case kind when 1 then 'Non-success response status 404: try later' when 2 then 'Non-success response status 503: try later'
  when 3 then 'Response body is not valid JSON' when 4 then 'an earlier page never landed.' end"""
API_ERROR_PAGE = "case kind when 1 then 5 when 2 then 4 when 3 then 6 when 4 then 4 end"


@query(
    "api_records",
    f"""select source, page_index, row_number() over (partition by source, page_index order by pos) - 1 as position, pos as id
      from ({API_ROWS}) r where page_index < {API_END}""",
)
def api_records(spark, sf_dir):
    return api_scan(spark, sf_dir).records.selectExpr(
        "source", "page_index", "position", "variant_get(document, '$.id', 'bigint') as id"
    )


@query(
    "api_errors",
    f"""select distinct source, page_index * {API_PAGE} as page, case kind when 1 then 404 when 2 then 503 else 200 end as status,
      {API_ERROR} as error from ({API_ROWS}) r where page_index = {API_ERROR_PAGE}""",
)
def api_errors(spark, sf_dir):
    return api_scan(spark, sf_dir).errors.selectExpr("source", "page", "status", "error")


@query(
    "api_summary",
    f"""select source, count(distinct page_index) filter (page_index < {API_END}) as pages_fetched,
      count(*) filter (page_index < {API_END}) as record_count,
      coalesce(max((page_index = {API_ERROR_PAGE})::int), 0)::bigint as error_count from ({API_ROWS}) r group by source""",
)
def api_summary(spark, sf_dir):
    return api_scan(spark, sf_dir).summary.selectExpr(
        "source", "pages_fetched", "record_count", "error_count"
    )


@query(
    "api_new_records",
    f"""select source, pos as id from ({API_ROWS}) r join (select source as s, max(pos) - 60 as mark from ({API_ROWS}) m
      where kind != 3 group by source) marks on source = s and pos > mark where page_index < {API_END}
      union all select source, pos from ({API_ROWS}) r where kind = 3 and page_index < {API_END}""",
)
def api_new_records(spark, sf_dir):
    """Past each API's own checkpoint; those of one kind have none yet."""
    scan = api_scan(spark, sf_dir)
    marks = f"""select source as source_name, cast(max(pos) - 60 as string) as last_processed_id from ({API_ROWS}) m
      where kind != 3 group by source"""
    return scan.newer_than(sql(spark, sf_dir, marks, "part")).selectExpr(
        "source", "variant_get(document, '$.id', 'bigint') as id"
    )
