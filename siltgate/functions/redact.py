"""Hide values whose column or key name looks sensitive."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from siltgate.fixed_values import REDACTED, SENSITIVE_NAME
from siltgate.functions.text import lit, matches, name


def redact_columns(df: DataFrame) -> DataFrame:
    """Replace whole columns by name; decided on the schema, so nothing is read for them."""
    sensitive = re.compile(SENSITIVE_NAME, re.IGNORECASE)
    return df.selectExpr(
        *[f"{lit(REDACTED)} as {name(c)}" if sensitive.search(c) else name(c) for c in df.columns]
    )


def redact_map(entries: str) -> str:
    """Replace the values of sensitive keys in a map<string,string>."""
    hit = matches("k", "(?i)" + SENSITIVE_NAME)
    return f"transform_values({entries}, (k, v) -> case when {hit} then {lit(REDACTED)} else v end)"
