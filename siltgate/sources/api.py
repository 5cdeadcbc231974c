"""An API source read from its landed response log: attempts, pages and records in one chain.

The log has one row per attempt: ``source, page_index, attempt, status, url, body``, with a NULL
status for a request that failed. Several APIs may share a log; each is walked on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.fixed_values import BACKOFF_SECONDS, MAX_RETRIES
from siltgate.operators.incremental import id_text, keep_new_by_source
from siltgate.operators.responses import (
    Paging,
    assemble,
    final_attempts,
    page_metadata,
    page_summary,
    parse,
    require_authorized,
)
from siltgate.session import stage
from siltgate.sources.delivery import deliver

# A record's number in its walk: its page, then its place in the page.
PLACE_BITS = 32


@dataclass(frozen=True)
class ApiScan:
    """``records``: source, page_index, position, record_number, ``document`` VARIANT.

    ``errors``: source, page, status, error; one row where a walk ended early. ``pages``: one row
    per page fetched. ``error_count`` is known, so asking for it reads nothing.
    """

    records: DataFrame
    errors: DataFrame
    pages: DataFrame
    summary: DataFrame
    record_count: int
    error_count: int

    def newer_than(self, checkpoints: DataFrame, id_field: str = "id") -> DataFrame:
        """The records past their own source's checkpoint."""
        value = f"try_variant_get(document, '$.{id_field}', 'variant')"
        marked = self.records.withColumn("_id", F.expr(id_text(value)))
        return keep_new_by_source(marked, checkpoints, "_id", "source").drop("_id")


def read_responses(
    log: DataFrame,
    paging: Paging = Paging(),
    max_retries: int = MAX_RETRIES,
    backoff_seconds: float = BACKOFF_SECONDS,
) -> ApiScan:
    """Walk every API of ``log`` as the paging rules say, and read the pages it reaches.

    Per page the first attempt that ends it counts; pages after the end of a walk are left out.
    Rejected credentials fail the run; any other failure ends that API's walk with one error row.
    The log is read once: its parsed pages are staged, and so are records and errors.
    """
    final = require_authorized(final_attempts(log, max_retries, backoff_seconds))
    parsed = stage(parse(final, paging).drop("body"), "responses")
    walked = assemble(parsed, paging)
    read = walked.select(
        "source",
        F.col("page_index").cast("bigint").alias("page_index"),
        "page",
        "status",
        "error",
        # A page without records gives no row, unless it is an error.
        F.posexplode_outer(F.expr("case when error is null then payload end")).alias("position", "document"),
    ).where("error is not null or position is not null")
    landed = deliver(read, "error is not null", "api")
    return ApiScan(
        landed.records.select(
            "source",
            "page_index",
            F.col("position").cast("bigint").alias("position"),
            F.expr(f"shiftleft(page_index, {PLACE_BITS}) + position").alias("record_number"),
            "document",
        ),
        landed.errors.select("source", "page", "status", "error"),
        page_metadata(walked),
        page_summary(walked),
        landed.record_count,
        landed.error_count,
    )
