"""Runs from landed records to loaded tables, per source or merged."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.fixed_values import API, CSV, DEFAULT_VERSION, MONGO
from siltgate.operators.canonical import Transformation, transform, union_sources
from siltgate.operators.incremental import id_text, keep_new
from siltgate.operators.rulesets import Registry, default_registry
from siltgate.operators.validate import Validation, error_rows, validate
from siltgate.plans.load import last_processed_id, load
from siltgate.session import configure, stage
from siltgate.sinks.buckets import BucketedTable
from siltgate.sinks.tables import TargetTable


@dataclass(frozen=True)
class Source:
    """One configured source: its rule set, its id field and its table."""

    name: str
    source_type: str
    id_field: str
    table: str
    # The name records carry; only API records get one of their own.
    record_source: str = "unknown"
    version: str = DEFAULT_VERSION


CSV_USERS = Source("csv_users", CSV, "user_id", "etl_csv_users")
API_PRODUCTS = Source("api_products", API, "id", "etl_api_products", "api_source")
DOCUMENT_USERS = Source("mongo_users", MONGO, "user_id", "etl_mongo_users")
SOURCES = (CSV_USERS, API_PRODUCTS, DOCUMENT_USERS)


@dataclass(frozen=True)
class Batch:
    """What a source delivered: flat text columns, or a VARIANT ``document`` column.

    ``errors`` are rows the source could not read, ``error_count`` their number where the
    source counted them while it was read. ``order`` names a column that orders the records;
    of rows with one key the last is loaded.
    """

    records: DataFrame
    document: str | None = None
    errors: DataFrame | None = None
    order: str | None = None
    null_is_missing: bool = False
    error_count: int | None = None


class Extractor(Protocol):
    """A source to be read: a run asks it for its batch."""

    def extract(self, spark: SparkSession, run_ts: datetime) -> Batch: ...


@dataclass(frozen=True)
class Prepared:
    validation: Validation
    transformation: Transformation


@dataclass(frozen=True)
class RunResult:
    """Rejected rows are always returned; ``counts`` are those of the load."""

    rejected: DataFrame
    untransformed: DataFrame
    validation_summary: DataFrame
    transform_summary: DataFrame
    counts: dict[str, int] = field(default_factory=dict)


def only_new(batch: Batch, source: Source, last_id: str | None) -> DataFrame:
    """The records past the checkpoint."""
    if last_id is None:
        return batch.records
    if batch.document is None:
        return keep_new(batch.records, source.id_field, last_id)
    value = f"try_variant_get(`{batch.document}`, '$.{source.id_field}', 'variant')"
    marked = batch.records.withColumn("_id", F.expr(id_text(value)))
    return keep_new(marked, "_id", last_id).drop("_id")


def prepare(
    batch: Batch,
    source: Source,
    run_ts: datetime,
    last_id: str | None = None,
    registry: Registry | None = None,
    staged: bool = False,
) -> Prepared:
    """Filter, validate and map one source. Lazy, unless ``staged``: then the checked
    records are computed once and kept, for runs that read them several times."""
    rules = (registry or default_registry()).resolve(source.source_type, source.version)
    records = only_new(batch, source, last_id).withColumn("source_name", F.lit(source.record_source))
    carry = [batch.order] if batch.order else []
    checked = validate(records, rules, run_ts, batch.document, carry, batch.null_is_missing)
    if staged:
        checked = Validation(stage(checked.checked, source.name), rules)
    return Prepared(checked, transform(checked.accepted, source.source_type, run_ts))


def merged(prepared: dict[str, Prepared]) -> DataFrame:
    """All sources' mapped records in one frame."""
    return union_sources({t: p.transformation.transformed for t, p in prepared.items()})


def accepted_per_source(prepared: dict[str, Prepared]) -> DataFrame:
    """Accepted records per source, sources without any included (as 0)."""
    counts = None
    for source_name, p in prepared.items():
        row = p.validation.checked.selectExpr(
            f"'{source_name}' as source_name", "count_if(size(errors) = 0) as accepted"
        )
        counts = row if counts is None else counts.unionAll(row)
    return counts


def _require_clean(batch: Batch, source: Source, on_source_error: str) -> None:
    if on_source_error not in ("fail", "keep"):
        raise ValueError("on_source_error must be 'fail' or 'keep'")
    if on_source_error == "fail" and batch.errors is not None and batch.error_count != 0:
        first = batch.errors.first()
        if first is not None:
            raise RuntimeError(f"{source.name} reported errors, such as: {first.asDict()}")


def run_source(
    spark: SparkSession,
    batch: Batch | Extractor,
    source: Source,
    folder: str,
    run_ts: datetime,
    on_source_error: str = "fail",
    strict: bool = True,
    mode: str = "insert_new",
    registry: Registry | None = None,
    buckets: int | None = None,
) -> RunResult:
    """Read past the checkpoint, validate, map and load one source into ``folder``.

    ``strict`` fails the run when a validated record cannot be mapped. With ``buckets`` the
    target is laid out by key, so that a load rewrites only what it touches.
    """
    configure(spark)
    batch = _extracted(spark, batch, run_ts)
    _require_clean(batch, source, on_source_error)
    checkpoints = TargetTable.named(spark, folder, "etl_metadata")
    last_id = last_processed_id(checkpoints.read(), source.name)
    prepared = prepare(batch, source, run_ts, last_id, registry, staged=True)
    transformation = prepared.transformation
    if strict:
        first = transformation.rejected.first()
        if first is not None:
            raise RuntimeError(f"transformation rejected records, such as: {first['error']}")
    if buckets:
        target = BucketedTable.named(spark, folder, source.table, buckets)
    else:
        target = TargetTable.named(spark, folder, source.table)
    order = [batch.order] if batch.order else None
    counts = load(_loadable(transformation, batch), target, checkpoints, source.name, run_ts, order, mode)
    return RunResult(
        error_rows(prepared.validation.checked),
        transformation.rejected,
        prepared.validation.summary,
        transformation.summary(strict),
        counts,
    )


def _loadable(transformation: Transformation, batch: Batch) -> DataFrame:
    """Mapped rows; the order column travels along for last-write-wins."""
    rows = transformation.transformed
    if batch.order is None:
        return rows
    names = rows.schema["canonical_record"].dataType.names
    fields = ", ".join(f"'{n}', canonical_record.`{n}`" for n in names)
    return rows.withColumn(
        "canonical_record", F.expr(f"named_struct({fields}, '{batch.order}', `{batch.order}`)")
    )


def _extracted(spark: SparkSession, given: Batch | Extractor, run_ts: datetime) -> Batch:
    return given if isinstance(given, Batch) else given.extract(spark, run_ts)


class RunFailed(RuntimeError):
    """Some sources failed; ``results`` has the others', which were loaded all the same."""

    def __init__(self, failures: dict[str, Exception], results: dict[str, RunResult]):
        super().__init__("; ".join(f"{name}: {failure}" for name, failure in failures.items()))
        self.failures, self.results = failures, results


def run_all(
    spark: SparkSession,
    batches: dict[str, Batch | Extractor],
    folder: str,
    run_ts: datetime,
    sources: tuple[Source, ...] = SOURCES,
    **options,
) -> dict[str, RunResult]:
    """Every source into its own table, side by side, each read in its own thread.

    A source's jobs go to a scheduler pool of its name, so under ``spark.scheduler.mode=FAIR``
    a long source does not hold up a short one. A source without records loads nothing and
    leaves its checkpoint alone. One that fails does not stop the others: the run raises
    RunFailed when all have ended.
    """
    chosen = [s for s in sources if s.name in batches]

    def one(source: Source) -> RunResult | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", source.name)
        try:
            return run_source(spark, batches[source.name], source, folder, run_ts, **options)
        except Exception as failure:  # told after the others have ended
            return failure
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, len(chosen))) as threads:
        ended = [threads.submit(inheritable_thread_target(spark)(one), s) for s in chosen]
    outcomes = {s.name: e.result() for s, e in zip(chosen, ended)}
    results = {n: o for n, o in outcomes.items() if isinstance(o, RunResult)}
    failures = {n: o for n, o in outcomes.items() if not isinstance(o, RunResult)}
    if failures:
        raise RunFailed(failures, results)
    return results
