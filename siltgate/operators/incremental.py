"""Keep only records newer than a source's checkpoint, and find the next checkpoint.

Ids compare as numbers when both sides are whole numbers, as text when both are
text. A record stays when there is no checkpoint, no id, or nothing to compare.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.functions import numbers
from siltgate.functions import variants as v
from siltgate.functions.text import lit, name
from siltgate.session import broadcast_if_small, stage

WIDE = "decimal(38,0)"
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_int(value: str | None) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def id_text(variant: str) -> str:
    """A document's id as text for comparing: floats lose their fraction, nested values are no id."""
    number = f"try_variant_get({variant}, '$', 'double')"
    return (
        f"case {v.kind(variant)} when '{v.TEXT}' then {v.plain_text(variant)}"
        f" when '{v.INT}' then {v.plain_text(variant)}"
        f" when '{v.BOOL}' then string(int(try_variant_get({variant}, '$', 'boolean')))"
        f" when '{v.DECIMAL}' then string({numbers.truncated(number)})"
        f" when '{v.DOUBLE}' then string({numbers.truncated(number)}) end"
    )


def newer_than(df: DataFrame, id_column: str, last_id: str | None) -> str:
    """SQL predicate that keeps new records.

    On an integer column it is a plain comparison, which reaches the scan.
    """
    column = name(id_column)
    if last_id is None:
        return "true"
    last = _as_int(last_id)
    if isinstance(df.schema[id_column].dataType, INTEGRAL):
        # A number does not compare with a text checkpoint, so it stays.
        if last is None:
            return "true"
        return f"({column} is null or {column} > {last})"
    is_int = f"coalesce({numbers.is_int_text(column)}, false)"
    if last is None:
        return f"({column} is null or {is_int} or {column} > {lit(last_id)})"
    small = f"{numbers.int_from_text(column)} > {last}"
    wide = f"{numbers.int_from_text(column, WIDE)} > cast('{last}' as {WIDE})"
    compared = f"coalesce({small}, {wide}, true)" if abs(last) < 2**63 else f"coalesce({wide}, true)"
    return f"({column} is null or not {is_int} or {compared})"


def keep_new(df: DataFrame, id_column: str, last_id: str | None) -> DataFrame:
    return df.filter(newer_than(df, id_column, last_id))


def keep_new_by_source(
    df: DataFrame,
    checkpoints: DataFrame,
    id_column: str,
    source_column: str = "source_name",
    mark: str | None = None,
) -> DataFrame:
    """As keep_new with each row's own source's checkpoint. With ``mark`` all rows stay, and a
    column of that name tells the new ones.

    The checkpoint table has one row per source. It is staged, so that the size of its files
    decides the join whatever it is derived from: a small one goes to every task, and the rows
    of a hot source stay where they are.
    """
    marks = checkpoints.selectExpr(
        "source_name as _mark_source",
        "last_processed_id as _mark",
        f"{numbers.int_from_text('last_processed_id')} as _mark_small",
        f"{numbers.int_from_text('last_processed_id', WIDE)} as _mark_wide",
    )
    column = name(id_column)
    if isinstance(df.schema[id_column].dataType, INTEGRAL):
        newer = (
            f"case when _mark_small is not null then {column} > _mark_small"
            f" when _mark_wide is not null then {column} > _mark_wide else true end"
        )
    else:
        found = f"({numbers.int_from_text(column, WIDE)})"
        newer = (
            f"case when _mark_wide is not null then {found} is null or {found} > _mark_wide"
            f" else {found} is not null or {column} > _mark end"
        )
    keep = f"_mark is null or {column} is null or {newer}"
    marks = broadcast_if_small(stage(marks, "marks"))
    joined = df.join(marks, F.col(source_column) == F.col("_mark_source"), "left")
    kept = joined.withColumn(mark, F.expr(f"coalesce({keep}, true)")) if mark else joined.filter(keep)
    return kept.drop("_mark_source", "_mark", "_mark_small", "_mark_wide")


def filter_counts(df: DataFrame, id_column: str, last_id: str | None) -> DataFrame:
    """total_found, new and skipped, in one pass."""
    keep = newer_than(df, id_column, last_id)
    return df.selectExpr(
        "count(1) as total_found", f"count_if({keep}) as new", f"count_if(not {keep}) as skipped"
    )


def next_checkpoint(df: DataFrame, id_column: str, by: str | None = None) -> DataFrame:
    """``last_processed_id``: the largest number when every id is one, else the largest text.

    Only partial maxima are shuffled, so a hot source costs one row per task.
    """
    if isinstance(df.schema[id_column].dataType, INTEGRAL):
        largest = F.max(name(id_column)).cast("string").alias("last_processed_id")
        return df.filter(F.col(name(id_column)).isNotNull()).groupBy(*([by] if by else [])).agg(largest)
    column = f"cast({name(id_column)} as string)"
    small, wide = numbers.int_from_text("_id"), numbers.int_from_text("_id", WIDE)
    grouped = df.selectExpr(*([name(by)] if by else []), f"{column} as _id").filter("_id is not null")
    partial = grouped.groupBy(*([by] if by else [])).agg(
        F.expr(f"max({small})").alias("_small"),
        F.expr(f"max(case when {small} is null then {wide} end)").alias("_wide"),
        F.expr(f"bool_and({numbers.is_int_text('_id')})").alias("_numeric"),
        F.max("_id").alias("_text"),
    )
    largest = f"greatest(cast(_small as {WIDE}), _wide)"
    return partial.selectExpr(
        *([name(by)] if by else []),
        f"case when _numeric then coalesce(string({largest}), _text) else _text end as last_processed_id",
    )


def advanced(old: str, new: str) -> str:
    """The later of two checkpoints, so a late batch cannot move one backward."""
    old_int, new_int = numbers.int_from_text(old, WIDE), numbers.int_from_text(new, WIDE)
    return (
        f"case when {new} is null then {old} when {old} is null then {new}"
        f" when ({old_int}) is not null and ({new_int}) is not null"
        f" then case when ({new_int}) >= ({old_int}) then {new} else {old} end"
        f" else greatest({old}, {new}) end"
    )
