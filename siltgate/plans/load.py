"""Load one batch into a target table and move the source's checkpoint."""

from __future__ import annotations

from datetime import datetime
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.fixed_values import LOAD_TIME_COLUMN
from siltgate.functions.text import lit, name
from siltgate.operators.canonical import flatten
from siltgate.operators.incremental import advanced, next_checkpoint
from siltgate.operators.upsert import last_wins, mark_existing, require_key, upsert
from siltgate.session import stage
from siltgate.sinks.buckets import BucketedTable
from siltgate.sinks.tables import TargetTable, to_target

MODES = ("insert_new", "upsert")
# Sources loaded side by side move their marks in one table, one after another.
_checkpoints_in_use = Lock()


def last_processed_id(checkpoints: DataFrame, source: str) -> str | None:
    """The source's checkpoint, or None; the table has one row per source."""
    row = checkpoints.filter(F.col("source_name") == source).select("last_processed_id").first()
    return row["last_processed_id"] if row else None


def checkpoint_row(batch: DataFrame, key: str, source: str, run_ts: datetime) -> DataFrame:
    """The checkpoint a batch leads to, in the checkpoint table's columns."""
    now = f"to_timestamp({lit(run_ts.isoformat())})"
    return next_checkpoint(batch, key).selectExpr(
        f"{lit(source)} as source_name",
        f"{now} as last_successful_run",
        "last_processed_id",
        f"{now} as last_processed_timestamp",
        f"{now} as updated_at",
    )


def upsert_checkpoint(checkpoints: DataFrame, row: DataFrame) -> DataFrame:
    """The checkpoint table after the run; a source's id never moves backward."""
    old = checkpoints.selectExpr("source_name", "last_processed_id as _old")
    row = row.join(old, "source_name", "left")
    row = row.withColumn("last_processed_id", F.expr(advanced("_old", "last_processed_id"))).drop("_old")
    return upsert(checkpoints, row, "source_name")


def load_summary(marked: DataFrame, flag: str, mode: str = "insert_new") -> DataFrame:
    """inserted, updated and skipped rows of a batch marked with what the target had."""
    skipped = f"count_if({name(flag)})" if mode == "insert_new" else "0L"
    updated = "0L" if mode == "insert_new" else f"count_if({name(flag)})"
    return marked.selectExpr(
        f"count_if(not {name(flag)}) as inserted", f"{updated} as updated", f"{skipped} as skipped"
    )


def load(
    records: DataFrame,
    target: TargetTable | BucketedTable,
    checkpoints: TargetTable,
    source: str,
    run_ts: datetime,
    order: list[str] | None = None,
    mode: str = "insert_new",
) -> dict[str, int]:
    """Write the batch and return inserted, updated and skipped.

    ``insert_new`` adds rows whose key the target lacks and only appends files;
    ``upsert`` also overwrites matched rows, which writes a new version of a plain
    table and the touched buckets of a bucketed one. A plain table counts rows, a
    bucketed one keys, so that rows with the same key count once there. Of rows
    with the same key the last in ``order`` is written. An empty batch writes
    nothing. The checkpoint is written last: after a failure in between a rerun
    skips the rows that were loaded.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    flat = flatten(records, target.key)
    require_key(flat, target.key)
    order = order or [target.key]
    typed = to_target(flat, target.schema).rows
    bucketed = isinstance(target, BucketedTable)
    if bucketed:  # finds out for itself which keys it has
        marked = typed.withColumn("_exists", F.lit(False))
    else:
        marked = mark_existing(typed, target.read(), target.key, "_exists")
    batch = stage(marked, "batch")

    key = name(target.key)
    facts = batch.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(key).isNull()).alias("keyless"),
        F.count_if(F.col("fault").isNotNull()).alias("faults"),
        F.min("fault").alias("fault"),
        F.count_if(F.col("_exists")).alias("existing"),
    ).first()
    if facts["rows"] == 0:
        return {"inserted": 0, "updated": 0, "skipped": 0}
    if facts["faults"]:
        raise ValueError(f"{facts['faults']} rows do not fit the target, such as: {facts['fault']}")
    if facts["keyless"]:
        raise ValueError(f"{facts['keyless']} rows have no {target.key}")

    inserting = mode == "insert_new"
    counts = {
        "inserted": facts["rows"] - facts["existing"],
        "updated": 0 if inserting else facts["existing"],
        "skipped": facts["existing"] if inserting else 0,
    }
    fresh = batch.filter("not _exists") if inserting else batch
    fresh = last_wins(fresh, target.key, order)
    known = set(T.StructType.fromDDL(target.schema).names)
    fresh = fresh.select(*[name(c) for c in flat.columns if c in known])
    stamp = _load_time(target)
    if stamp:
        fresh = fresh.withColumn(stamp, F.to_timestamp(F.lit(run_ts.isoformat())))
    if bucketed:
        written = target.insert_new(fresh) if inserting else target.upsert(fresh)
        counts = {"inserted": written.inserted, "updated": written.updated, "skipped": written.known if inserting else 0}
    elif inserting:
        if counts["inserted"]:
            target.append(fresh)
    else:
        target.replace(upsert(target.read(), fresh, target.key))
    row = stage(checkpoint_row(batch, target.key, source, run_ts), "checkpoint")
    with _checkpoints_in_use:
        checkpoints.replace(upsert_checkpoint(checkpoints.read(), row))
    return counts


def _load_time(target: TargetTable | BucketedTable) -> str | None:
    table = target.path.rsplit("/", 1)[-1]
    return LOAD_TIME_COLUMN.get(table)
