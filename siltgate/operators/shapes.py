"""The row shapes a run hands on: one outcome per record, and the envelope all sources share."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from siltgate.functions.text import lit, name

# What every record of any source carries before it is checked.
ENVELOPE = (
    "source_name string, source_type string, record_id string, ingestion_timestamp timestamp,"
    " raw_record map<string,string>, normalized_record map<string,string>"
)


def outcomes(checked: DataFrame) -> DataFrame:
    """One row per record: ``valid``, the ``validated_record`` if it is, and its ``errors``.

    An error is (field_name, message, error_code, context), its context what failed, if known.
    """
    context = "case when e.input is not null then map('input', e.input) end"
    error = (
        "named_struct('field_name', e.field_name, 'message', e.message, 'error_code', e.error_code,"
        f" 'context', {context})"
    )
    record = (
        "named_struct('source_name', source_name, 'source_type', source_type, 'record_id', record_id,"
        " 'normalized_record', record, 'validated_at', validated_at, 'schema_version', schema_version)"
    )
    return checked.selectExpr(
        "record_id",
        "source_name",
        "source_type",
        "size(errors) = 0 as valid",
        f"case when size(errors) = 0 then {record} end as validated_record",
        f"transform(errors, e -> {error}) as errors",
    )


def enveloped(
    rows: DataFrame, source_type: str, id_column: str, run_ts: datetime, source_name: str = "unknown", raw: str | None = None
) -> DataFrame:
    """Flat rows in the shared envelope; ``raw`` names a map of a record as it came, else the
    columns' own texts stand for it. A column that is NULL is there, without a value."""
    fields = [c for c in rows.columns if c != raw]
    pairs = ", ".join(f"{lit(c)}, cast({name(c)} as string)" for c in fields)
    normalized = f"map({pairs})" if fields else "cast(map() as map<string,string>)"
    return rows.selectExpr(
        f"{lit(source_name)} as source_name",
        f"{lit(source_type)} as source_type",
        f"coalesce(cast({name(id_column)} as string), 'unknown') as record_id",
        f"to_timestamp({lit(run_ts.isoformat())}) as ingestion_timestamp",
        f"{f'cast({name(raw)} as map<string,string>)' if raw else normalized} as raw_record",
        f"{normalized} as normalized_record",
    )
