"""Landed API responses: classify attempts, choose the final one, parse pages, stop the walk.

Input is a table of responses: ``source, page_index, attempt, status, url, body``;
``status`` is NULL for a failed request. ``page_index`` counts pages from 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.fixed_values import (
    AUTH_STATUSES,
    BACKOFF_SECONDS,
    BODY_EXCERPT,
    MAX_RETRIES,
    NEITHER,
    NOT_JSON,
    RETRY_STATUSES,
)
from siltgate.functions import variants as v
from siltgate.functions.text import lit
from siltgate.operators.prefix import running_total_before
from siltgate.session import broadcast_if_small, counted, stage

PAGE = ["source", "page_index"]


@dataclass(frozen=True)
class Paging:
    """How pages are asked for, and where a body keeps its records and its total."""

    style: str = "page"
    start_page: int = 1
    page_size: int | None = None
    max_pages: int | None = None
    records_path: str | None = None
    total_path: str | None = None

    def __post_init__(self) -> None:
        if self.style not in ("page", "offset"):
            raise ValueError(f"style must be 'page' or 'offset', got {self.style!r}")

    def label(self, index: str) -> str:
        """SQL for the page value sent to the API; the index itself without paging."""
        if not self.page_size:
            return index
        step = self.page_size if self.style == "offset" else 1
        return f"({self.start_page} + {index} * {step})"


def page_plan(spark: SparkSession, paging: Paging, pages: int) -> DataFrame:
    """The page value and size of each request; one bare request without paging."""
    if not paging.page_size:
        return spark.range(1).selectExpr(
            "id as page_index", "cast(null as bigint) as page_value", "cast(null as int) as page_size"
        )
    return spark.range(pages).selectExpr(
        "id as page_index", f"{paging.label('id')} as page_value", f"{paging.page_size} as page_size"
    )


def landed_requests(pages: DataFrame, paging: Paging) -> DataFrame:
    """Per source, the requests of a walk up to its last landed page, landed or not."""
    last = pages.groupBy("source").agg(F.max("page_index").cast("bigint").alias("last"))
    steps = last.selectExpr("source", "explode(sequence(0L, last)) as page_index")
    size = "null" if paging.page_size is None else paging.page_size
    return steps.selectExpr(
        "source", "page_index", f"{paging.label('page_index')} as page_value", f"cast({size} as int) as page_size"
    )


# --- attempts ---------------------------------------------------------------


def _listed(codes: tuple[int, ...]) -> str:
    return "(" + ", ".join(str(c) for c in codes) + ")"


def classify(responses: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Add ``outcome``: auth_error, success, retry or error.

    A request that failed, or a status worth retrying, is an error on the last attempt.
    """
    last = f"attempt > {max_retries}"
    return responses.withColumn(
        "outcome",
        F.expr(
            f"case when status in {_listed(AUTH_STATUSES)} then 'auth_error'"
            " when status < 400 then 'success'"
            f" when (status is null or status in {_listed(RETRY_STATUSES)}) and not ({last}) then 'retry'"
            " else 'error' end"
        ),
    )


def final_attempts(
    responses: DataFrame, max_retries: int = MAX_RETRIES, backoff_seconds: float = BACKOFF_SECONDS
) -> DataFrame:
    """One row per page: the first attempt that ends it, with ``error`` and the delay waited.

    Attempts past the allowed ones never happen and are ignored. A page whose
    attempts all ask for a retry is still open; its last attempt is shown. The
    rank is cut before the shuffle, so a page with many attempts sends few rows.
    """
    allowed = classify(responses, max_retries).filter(f"attempt <= {max_retries + 1}")
    order = Window.partitionBy(*PAGE).orderBy(
        F.expr("outcome = 'retry'"), F.expr("case when outcome = 'retry' then -attempt else attempt end")
    )
    excerpt = f"substring(body, 1, {BODY_EXCERPT})"
    error = (
        "case outcome when 'auth_error' then concat('Authentication failed with status ', status, '.')"
        " when 'error' then case when status is null"
        " then concat('Request failed after ', attempt, ' attempt(s)')"
        f" else concat('Non-success response status ', status, ': ', coalesce({excerpt}, '')) end end"
    )
    # Delays double: the sum of the first n is backoff * (2^n - 1).
    waited = f"{backoff_seconds} * (pow(2, attempt - 1) - 1)"
    return (
        allowed.withColumn("_rank", F.row_number().over(order))
        .filter("_rank = 1")
        .drop("_rank")
        .withColumns({"error": F.expr(error), "waited_seconds": F.expr(waited)})
    )


def retry_delays(responses: DataFrame, backoff_seconds: float = BACKOFF_SECONDS) -> DataFrame:
    """The delay scheduled after each attempt that asks for a retry."""
    delay = f"case when outcome = 'retry' then {backoff_seconds} * pow(2, attempt - 1) end"
    return responses.withColumn("delay_seconds", F.expr(delay))


def require_authorized(final: DataFrame) -> DataFrame:
    """Fail the run, when it is read, at the first page whose credentials were rejected."""
    failure = "raise_error(concat('authentication failed: ', error))"
    return final.withColumn(
        "outcome", F.expr(f"case when outcome = 'auth_error' then {failure} else outcome end")
    )


# --- pages ------------------------------------------------------------------


# Messages of this library alone.
NOT_ENDED = "no attempt brought an answer; the last asks for: "
NEVER_LANDED = "an earlier page never landed."


def parse(pages: DataFrame, paging: Paging) -> DataFrame:
    """Add ``payload`` (VARIANT records), ``n_records``, ``total`` and ``error``.

    A list gives its items, an object is one record, anything else is an error,
    as is a path that is not there. An ``error`` already set is kept.
    """
    keys = paging.records_path.split(".") if paging.records_path else []
    found = pages.withColumn("_body", F.expr("try_parse_json(body)"))
    total = v.field("_body", *paging.total_path.split(".")) if paging.total_path else "null"
    found = found.selectExpr(
        "*", f"{v.field('_body', *keys)} as _records", f"cast({total} as variant) as _total"
    )
    found = found.selectExpr("*", f"{v.kind('_records')} as _kind", f"{v.kind('_total')} as _total_kind")
    missing = lit(f"path '{paging.records_path}' not found in response payload.")
    error = (
        f"case when _body is null then {lit(NOT_JSON)}"
        f" when _kind = '{v.MISSING}' then {missing}"
        f" when _kind not in ('{v.LIST}', '{v.OBJECT}') then {lit(NEITHER)} end"
    )
    before = "error" if "error" in pages.columns else "null"
    if "outcome" in pages.columns:
        # A page that no attempt ended has a body, but not that of an answer.
        before = f"coalesce({before}, case when outcome <> 'success' then concat({lit(NOT_ENDED)}, outcome) end)"
    payload = (
        f"case _kind when '{v.LIST}' then {v.items('_records')}"
        f" when '{v.OBJECT}' then array(_records) end"
    )
    total_value = (
        f"case _total_kind when '{v.INT}' then try_variant_get(_total, '$', 'bigint')"
        f" when '{v.BOOL}' then bigint(try_variant_get(_total, '$', 'boolean')) end"
    )
    kept = [f"`{c}`" for c in pages.columns if c != "error"]
    read = found.selectExpr(
        *kept,
        f"{payload} as payload",
        f"{total_value} as total",
        f"cast(coalesce({before}, {error}) as string) as error",
    ).withColumn("n_records", F.expr("case when error is null then bigint(size(payload)) end"))
    return counted(read, "pages", pages="count(1)", failed="count(error)", records="sum(n_records)")


def _last_pages(parsed: DataFrame, paging: Paging) -> DataFrame:
    """Per source: the index of the page the walk ends at.

    Works on narrow rows without bodies, staged so that bodies are parsed for them
    only once. The rules that need only their own page are a minimum per source;
    the total needs the records of earlier pages, from a running total cut into
    bounded chunks.
    """
    facts = parsed.select(*PAGE, "n_records", "total", F.col("error").isNotNull().alias("failed"))
    if not paging.page_size:
        one = facts.groupBy("source").agg(F.min("page_index").alias("last_page"))
        return one.withColumn("gap_page", F.lit(None).cast("bigint"))
    stop = f"failed or n_records < {paging.page_size}"
    if paging.max_pages:
        stop += f" or page_index >= {paging.max_pages - 1}"
    facts = facts.withColumns({"n_records": F.coalesce("n_records", F.lit(0)), "_one": F.lit(1)})
    facts = running_total_before(stage(facts, "pages"), ["source"], "page_index", "_one", "pages_before")
    # The walk cannot pass a page that is not there.
    stop += " or pages_before <> page_index"
    if paging.total_path:
        facts = running_total_before(facts, ["source"], "page_index", "n_records", "before")
        stop += " or before + n_records >= total"
    last = facts.groupBy("source").agg(
        F.expr(f"min(case when {stop} then page_index end)").alias("_stop"),
        F.max("page_index").alias("_end"),
        F.min(F.when(F.col("pages_before") != F.col("page_index"), F.col("page_index"))).alias("gap_page"),
    )
    return last.select("source", F.coalesce("_stop", "_end").alias("last_page"), "gap_page")


def assemble(parsed: DataFrame, paging: Paging) -> DataFrame:
    """The pages the walk reaches, in order of ``page_index``, with their ``page`` label.

    Later pages are dropped, as they would not have been asked for. A page with an
    ``error`` ends the walk; it is kept, without records, as that source's error. So does
    the first page after one that never landed.
    """
    last = stage(_last_pages(parsed, paging), "last-pages")
    after_gap = F.coalesce(F.col("page_index") >= F.col("gap_page"), F.lit(False))
    return (
        parsed.join(broadcast_if_small(last), "source")
        .filter("page_index <= last_page")
        .withColumns(
            {
                "error": F.when(after_gap, F.coalesce("error", F.lit(NEVER_LANDED))).otherwise(F.col("error")),
                "n_records": F.when(~after_gap, F.col("n_records")),
            }
        )
        .drop("last_page", "gap_page")
        .withColumn("page", F.expr(paging.label("page_index")))
    )


def records(assembled: DataFrame) -> DataFrame:
    """One row per record: source, page_index, position in the page, ``record`` VARIANT."""
    return assembled.filter("error is null").select(
        *PAGE, F.posexplode("payload").alias("position", "record")
    )


def page_errors(assembled: DataFrame) -> DataFrame:
    kept = [c for c in ("source", "page", "status", "error") if c in assembled.columns]
    return assembled.filter("error is not null").select(*kept)


def page_metadata(assembled: DataFrame) -> DataFrame:
    """One row per fetched page."""
    kept = [c for c in ("source", "page", "status", "url", "n_records", "total") if c in assembled.columns]
    return assembled.filter("error is null").select(*kept)


def page_summary(assembled: DataFrame) -> DataFrame:
    """Per source: pages fetched, records, errors. Page rows stay in page_metadata,
    as a list of them per source would have no bound."""
    return assembled.groupBy("source").agg(
        F.expr("count_if(error is null)").alias("pages_fetched"),
        F.expr("coalesce(sum(n_records), 0L)").alias("record_count"),
        F.expr("count_if(error is not null)").alias("error_count"),
        F.expr("min(case when error is null then page end)").alias("first_page"),
        F.expr("max(case when error is null then page end)").alias("last_page"),
    )
