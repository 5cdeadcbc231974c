"""Keyed loads: new rows only, last write wins, upsert, JSON payloads, new keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from siltgate.functions.text import name

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def require_key(df: DataFrame, key: str) -> None:
    if key not in df.columns:
        raise ValueError(f"records lack the id column {key!r}")


def _match_key(df: DataFrame, key: str, other: DataFrame) -> Column:
    """The key as both sides compare it: as it is when both hold whole numbers, else as text."""
    kinds = [d.schema[key].dataType for d in (df, other)]
    if all(isinstance(k, INTEGRAL) for k in kinds):
        return F.col(name(key)).cast("bigint")
    return F.col(name(key)).cast("string")


def existing_keys(target: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of the target, as text."""
    return target.select(F.col(name(key)).cast("string").alias(key)).filter(
        F.col(name(key)).isNotNull()
    ).distinct()


def _against_target(batch: DataFrame, target: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join on the key alone. The target is pruned to its key column, and
    the batch keeps its rows in place; a hot batch key is split by the skew join."""
    require_key(batch, key)
    keys = target.select(_match_key(target, key, batch).alias("_key"))
    return batch.withColumn("_key", _match_key(batch, key, target)).join(keys, "_key", how).drop("_key")


def new_records(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target lacks; a NULL key matches nothing."""
    return _against_target(batch, target, key, "left_anti")


def skipped_records(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target has already."""
    return _against_target(batch, target, key, "left_semi")


def mark_existing(batch: DataFrame, target: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: whether the target has the row's key. The target's keys are unique."""
    require_key(batch, key)
    keys = target.select(_match_key(target, key, batch).alias("_key"), F.lit(True).alias(flag))
    marked = batch.withColumn("_key", _match_key(batch, key, target)).join(keys, "_key", "left")
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop("_key")


def last_wins(batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``.

    The row-number limit runs before the shuffle too, so a hot key sends one row per task.
    """
    require_key(batch, key)
    latest = Window.partitionBy(name(key)).orderBy(*[F.desc(name(c)) for c in order])
    return batch.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target after writing ``batch`` (one row per key) over it.

    A matched row takes every column of the batch and keeps those the batch lacks;
    the rest is inserted. Columns new to the target are added.
    """
    require_key(batch, key)
    columns = target.columns + [c for c in batch.columns if c not in target.columns]
    old = target.select(
        _match_key(target, key, batch).alias("_key"), F.struct(*[name(c) for c in target.columns]).alias("_old")
    )
    new = batch.select(
        _match_key(batch, key, target).alias("_key"), F.struct(*[name(c) for c in batch.columns]).alias("_new")
    )

    def merged(c: str) -> Column:
        after, before = F.col("_new")[c], F.col("_old")[c]
        if c not in target.columns:
            return after.alias(c)
        kept = before if c not in batch.columns else F.when(
            F.col("_new").isNotNull(), after.cast(target.schema[c].dataType)
        ).otherwise(before)
        return kept.alias(c)

    return old.join(new, "_key", "full_outer").select(*[merged(c) for c in columns])


def payload_rows(batch: DataFrame, key: str, loaded_at: str) -> DataFrame:
    """Whole rows as JSON: the key, ``payload`` and ``updated_at``."""
    require_key(batch, key)
    return batch.select(
        F.col(name(key)),
        F.to_json(F.struct(*[name(c) for c in batch.columns]), {"ignoreNullFields": "false"}).alias(
            "payload"
        ),
        F.to_timestamp(F.lit(loaded_at)).alias("updated_at"),
    )
