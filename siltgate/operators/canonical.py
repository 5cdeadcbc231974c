"""Map accepted records to the columns of their target tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from siltgate.fixed_values import API, CSV, MONGO
from siltgate.functions.text import lit, strip

COMMON = {
    "source": "source_name",
    "source_type": "source_type",
    "validated_at": "validated_at",
}


def _stripped(*names: str) -> dict[str, str]:
    return {n: strip(f"record.{n}") for n in names}


def _kept(*names: str) -> dict[str, str]:
    return {n: f"record.{n}" for n in names}


def _csv_users(absent: str) -> dict[str, str]:
    return {
        **_stripped("user_id", "full_name"),
        "email": f"nullif({strip('record.email')}, '')",
        "phone": f"coalesce(nullif({strip('record.phone')}, ''), {absent})",
        "signup_date": "cast(record.signup_date as string)",
        **_stripped("country"),
        **_kept("age", "status"),
        "is_active": "record.status = 'active'",
        **_kept("newsletter_opt_in"),
        **COMMON,
    }


def _document_users(absent: str) -> dict[str, str]:
    first, last = strip("record.first_name"), strip("record.last_name")
    return {
        **_kept("user_id"),
        **_stripped("first_name", "last_name"),
        "full_name": strip(f"concat_ws(' ', coalesce({first}, ''), coalesce({last}, ''))"),
        **_stripped("email"),
        "phone": f"coalesce(nullif({strip('record.phone')}, ''), {absent})",
        **_stripped("gender"),
        "date_of_birth": "cast(record.date_of_birth as string)",
        **_stripped("city", "country", "address"),
        "is_active": "coalesce(record.is_active, false)",
        **_stripped("signup_source", "membership"),
        "created_at": "record.created_at.shown",
        "updated_at": "record.updated_at.shown",
        **COMMON,
    }


def _products(absent: str) -> dict[str, str]:
    return {
        "product_id": "record.id",
        **_stripped("title"),
        **_kept("description"),
        **_stripped("category"),
        **_kept("price", "discount_percentage", "rating", "stock"),
        "tags": "array_join(record.tags.items, ',')",
        **_kept("brand", "sku", "weight", "width", "height", "depth"),
        **_kept("warranty_information", "shipping_information", "availability_status"),
        "in_stock": "lower(coalesce(record.availability_status, '')) != 'out of stock'",
        **_kept("return_policy", "minimum_order_quantity", "barcode"),
        "created_at": f"coalesce(record.created_at.shown, {absent})",
        "updated_at": f"coalesce(record.updated_at.shown, {absent})",
        **_kept("thumbnail"),
        **COMMON,
    }


# By source type: the columns, and why a record cannot be mapped (NULL when it can).
MAPPINGS = {
    CSV: (_csv_users, "cast(null as string)"),
    MONGO: (
        _document_users,
        "case when record.user_id is null then 'int() argument must be a string, a bytes-like object"
        " or a real number, not \\'NoneType\\'' end",
    ),
    API: (_products, "record.tags.fault"),
}


@dataclass(frozen=True)
class Transformation:
    """``mapped`` has every record, with ``error`` set where it could not be mapped."""

    mapped: DataFrame

    @property
    def transformed(self) -> DataFrame:
        return self.mapped.filter("error is null").drop("error")

    @property
    def rejected(self) -> DataFrame:
        return self.mapped.filter("error is not null").select(
            "record_id", "source_name", "source_type", "error"
        )

    def summary(self, strict: bool = False) -> DataFrame:
        return self.mapped.selectExpr(
            "count(1) as processed",
            "count_if(error is null) as accepted",
            "count_if(error is not null) as rejected",
            f"{str(strict).lower()} as strict_mode",
            "max(transformed_at) as transformed_at",
        )


def transform(
    accepted: DataFrame, source_type: str, run_ts: datetime, none_as_text: bool = False
) -> Transformation:
    """Map one source's accepted records; ``canonical_record`` is a struct in target order.

    An absent phone or product time is NULL; ``none_as_text`` writes ``None``.
    """
    if source_type not in MAPPINGS:
        raise ValueError(f"unknown source type: {source_type}")
    columns, fault = MAPPINGS[source_type]
    fields = ", ".join(
        f"'{n}', {e}" for n, e in columns(lit("None") if none_as_text else "null").items()
    )
    carried = [
        f"`{c}`"
        for c in accepted.columns
        if c not in ("record_id", "source_name", "source_type", "schema_version", "validated_at", "record")
    ]
    failed = f"({fault})"
    return Transformation(
        accepted.selectExpr(
            *carried,
            "record_id",
            "source_name",
            # A literal, so that routing by type drops the other sources' branches.
            f"{lit(source_type)} as source_type",
            "schema_version",
            f"named_struct({fields}) as canonical_record",
            f"{lit(run_ts.isoformat())} as transformed_at",
            f"case when {failed} is not null then"
            f" concat('Unable to transform record ', record_id, ': ', {failed}) end as error",
        )
    )


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """All sources in one frame: a typed struct column per source type, NULL in other rows."""
    merged = None
    for source_type, frame in frames.items():
        frame = frame.withColumnRenamed("canonical_record", f"{source_type}_record")
        merged = frame if merged is None else merged.unionByName(frame, allowMissingColumns=True)
    return merged


def route(merged: DataFrame, source_type: str) -> DataFrame:
    """One source's rows of the merged frame, back in their own shape."""
    others = [c for c in merged.columns if c.endswith("_record") and c != f"{source_type}_record"]
    return (
        merged.filter(f"source_type = {lit(source_type)}")
        .drop(*others)
        .withColumnRenamed(f"{source_type}_record", "canonical_record")
    )


def flatten(records: DataFrame, key: str) -> DataFrame:
    """Loader-ready flat rows: the canonical columns, the key from record_id when absent.

    Plain rows only lose the wrapper columns.
    """
    if "canonical_record" not in records.columns:
        return records.drop("source_name", "record_id", "schema_version")
    if not records.schema["canonical_record"].dataType.typeName() == "struct":
        raise TypeError("canonical_record must be a struct")
    inner = records.schema["canonical_record"].dataType.names
    extra = [] if key in inner else [f"record_id as `{key}`"]
    return records.selectExpr("canonical_record.*", *extra)
