"""Runtime-typed values: what kind a VARIANT holds, and its text.

Rules depend on the type a value has at run time (an int in a text field is an
error, "5" in an int field is not), so documents stay VARIANT until checked.
A kind is the start of the schema's name; an absent value has the kind '-'.
"""

from __future__ import annotations

MISSING = "-"
NULL = "VOI"
BOOL = "BOO"
INT = "BIG"
DECIMAL = "DEC"
DOUBLE = "DOU"
TEXT = "STR"
LIST = "ARR"
OBJECT = "OBJ"


def path_of(*keys: str) -> str:
    """A VARIANT path through object keys, as a SQL literal."""
    path = "$" + "".join('["' + key.replace('"', '\\"') + '"]' for key in keys)
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def field(variant: str, *keys: str) -> str:
    """The value under nested keys as VARIANT; SQL NULL when absent."""
    return f"try_variant_get({variant}, {path_of(*keys)}, 'variant')" if keys else variant


def kind(value: str) -> str:
    return f"coalesce(substring(schema_of_variant({value}), 1, 3), '{MISSING}')"


def plain_text(value: str) -> str:
    """Scalars as text, nested values as JSON."""
    return f"try_variant_get({value}, '$', 'string')"


def python_text(value: str, value_kind: str, text: str) -> str:
    """Scalars as Python's str() shows them; nested values as JSON. ``text`` is plain_text."""
    number = f"string(try_variant_get({value}, '$', 'double'))"
    # Whole numbers beyond 64 bits arrive as wide decimals without a fraction.
    wide = f"length({text}) > 18 and instr({text}, '.') = 0"
    return (
        f"case {value_kind} when '{TEXT}' then {text} when '{BOOL}' then initcap({text})"
        f" when '{DECIMAL}' then case when {wide} then {text} else {number} end"
        f" when '{DOUBLE}' then {number} else {text} end"
    )


def exported_date(value: str) -> str:
    """The text of an exported date, ``{"$date": ...}``: a date-time without offset."""
    inner = f"try_variant_get({value}, {path_of('$date')}, 'string')"
    return f"regexp_replace({inner}, 'Z$', '')"


def items(value: str) -> str:
    """The elements of a list value as array<variant>."""
    return f"try_variant_get({value}, '$', 'array<variant>')"
