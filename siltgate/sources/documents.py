"""Document exports: JSON lines to VARIANT documents, selection, envelopes, error rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.functions import variants as v
from siltgate.functions.text import lit, name
from siltgate.session import counted
from siltgate.sources.delivery import deliver

COMPARISONS = {"$gt": ">", "$gte": ">=", "$lt": "<", "$lte": "<="}


@dataclass(frozen=True)
class DocumentScan:
    """``documents``: source_collection, ingestion_timestamp, ``document`` VARIANT and
    what else the lines had. ``errors``: lines that hold no document."""

    documents: DataFrame
    errors: DataFrame
    # Known once the scan is landed.
    error_count: int | None = None

    def find(self, query: dict[str, Any] | None = None) -> DataFrame:
        return self.documents.filter(find_filter(query or {}, "document"))


def read_documents(
    spark: SparkSession, path: str, collection: str, run_ts: datetime
) -> DocumentScan:
    """One document per line, as exports write them; lines split across tasks."""
    return documents_from(spark.read.text(path), "value", collection, run_ts)


def documents_from(lines: DataFrame, column: str, collection: str, run_ts: datetime) -> DocumentScan:
    """Documents from JSON text in any frame; a line that is no JSON object is an error row."""
    others = [name(c) for c in lines.columns if c != column]
    parsed = lines.selectExpr(
        *others, f"{name(column)} as _line", f"try_parse_json({name(column)}) as document"
    ).selectExpr("*", f"{v.kind('document')} as _kind")
    parsed = counted(parsed, f"scan {collection}", documents=f"count_if(_kind = '{v.OBJECT}')", lines="count(1)")
    good, bad = parsed.filter(f"_kind = '{v.OBJECT}'"), parsed.filter(f"_kind != '{v.OBJECT}'")
    return _scan(good, bad, others, collection, run_ts)


def land_documents(lines: DataFrame, column: str, collection: str, run_ts: datetime) -> DocumentScan:
    """As documents_from, by one pass over ``lines``, which nothing after reads again."""
    others = [name(c) for c in lines.columns if c != column]
    parsed = lines.selectExpr(*others, f"{name(column)} as _line", f"try_parse_json({name(column)}) as document")
    parsed = parsed.selectExpr("*", f"{v.kind('document')} as _kind")
    # A record needs its line no more.
    parsed = parsed.withColumn("_line", F.expr(f"case when _kind != '{v.OBJECT}' then _line end"))
    landed = deliver(parsed, f"_kind != '{v.OBJECT}'", collection)
    return _scan(landed.records, landed.errors, others, collection, run_ts, landed.error_count)


def _scan(
    good: DataFrame,
    bad: DataFrame,
    others: list[str],
    collection: str,
    run_ts: datetime,
    error_count: int | None = None,
) -> DocumentScan:
    documents = good.selectExpr(
        *others,
        f"{lit(collection)} as source_collection",
        f"{lit(run_ts.isoformat())} as ingestion_timestamp",
        "document",
    )
    errors = bad.selectExpr(
        *others,
        f"{lit(collection)} as source_collection",
        f"case when _kind = '{v.MISSING}' then 'not valid JSON' else 'not a document' end as error",
        "_line as row",
    )
    return DocumentScan(documents, errors, error_count)


def key_text(document: str, key: str = "_id") -> str:
    """The document key as text, an exported object id by its hex digits."""
    raw = v.field(document, key)
    return (
        f"coalesce(try_variant_get({document}, {v.path_of(key, '$oid')}, 'string'),"
        f" {v.python_text(raw, v.kind(raw), v.plain_text(raw))})"
    )


def limited(documents: DataFrame, limit: int | None, order: str | None = None) -> DataFrame:
    """At most ``limit`` documents, the first in ``order``; 0 and None mean all."""
    if not limit:
        return documents
    return (documents.orderBy(name(order)) if order else documents).limit(limit)


def find_filter(query: dict[str, Any], document: str) -> str:
    """A selection in the document store's query form as a SQL predicate.

    Values compare within their own kind; on a list field any item may match.
    """
    clauses = []
    for key, wanted in query.items():
        if key in ("$and", "$or", "$nor"):
            parts = [f"({find_filter(part, document)})" for part in wanted]
            joined = (" and " if key == "$and" else " or ").join(parts)
            clauses.append(f"not ({joined})" if key == "$nor" else f"({joined})")
        elif isinstance(wanted, dict) and wanted and all(k.startswith("$") for k in wanted):
            clauses += [_condition(document, key, op, operand) for op, operand in wanted.items()]
        else:
            clauses.append(_condition(document, key, "$eq", wanted))
    return " and ".join(f"({c})" for c in clauses) or "true"


def _condition(document: str, key: str, op: str, operand: Any) -> str:
    value = v.field(document, *key.split("."))
    if op == "$exists":
        return f"{value} is {'not ' if operand else ''}null"
    if op == "$not":
        inner = " and ".join(_condition(document, key, o, x) for o, x in operand.items())
        return f"not ({inner})"
    if op == "$ne":
        return f"not ({_condition(document, key, '$eq', operand)})"
    if op == "$nin":
        return f"not ({_condition(document, key, '$in', operand)})"
    if op == "$in":
        return " or ".join(_condition(document, key, "$eq", x) for x in operand) or "false"
    if op != "$eq" and op not in COMPARISONS:
        raise ValueError(f"unsupported query operator: {op}")
    if operand is None:
        return f"{v.kind(value)} in ('{v.MISSING}', '{v.NULL}')"
    sign = COMPARISONS.get(op, "=")
    any_item = f"exists({v.items(value)}, e -> {_compare('e', sign, operand)})"
    return f"coalesce({_compare(value, sign, operand)}, false) or coalesce({any_item}, false)"


def _compare(value: str, sign: str, operand: Any) -> str:
    kind = v.kind(value)
    if isinstance(operand, bool):
        got = f"try_variant_get({value}, '$', 'boolean') {sign} {str(operand).lower()}"
        return f"({kind} = '{v.BOOL}' and {got})"
    if isinstance(operand, int):
        whole = f"try_variant_get({value}, '$', 'bigint') {sign} {operand}"
        number = f"try_variant_get({value}, '$', 'double') {sign} {operand}"
        return (
            f"case {kind} when '{v.INT}' then {whole}"
            f" when '{v.DECIMAL}' then {number} when '{v.DOUBLE}' then {number} else false end"
        )
    if isinstance(operand, float):
        number = f"try_variant_get({value}, '$', 'double') {sign} {operand!r}D"
        return f"({kind} in ('{v.INT}', '{v.DECIMAL}', '{v.DOUBLE}') and {number})"
    if isinstance(operand, str):
        return f"({kind} = '{v.TEXT}' and {v.plain_text(value)} {sign} {lit(operand)})"
    raise ValueError(f"unsupported query value: {operand!r}")
