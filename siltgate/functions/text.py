"""String helpers with Python's blank rules."""

from __future__ import annotations

from collections.abc import Iterable

from siltgate.fixed_values import BLANKS


def lit(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def words(values: Iterable[str]) -> str:
    """A SQL list of string literals, for IN."""
    return "(" + ", ".join(lit(v) for v in values) + ")"


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def strip(text: str) -> str:
    """Trim every Unicode blank at both ends (plain ``trim`` takes spaces only)."""
    return f"btrim({text}, {lit(BLANKS)})"


def blank_to_null(text: str) -> str:
    """The stripped text, or NULL when nothing is left."""
    return f"nullif({strip(text)}, '')"


def all_blank(columns: Iterable[str]) -> str:
    """True when every column is NULL or blank."""
    return strip(f"concat_ws('', {', '.join(columns)})") + " = ''"


def quoted(text: str) -> str:
    """Text in single quotes, as messages show it."""
    return f"concat('\\'', {text}, '\\'')"


def malformed_email(text: str) -> str:
    """No ``@``, or no dot after the last ``@``."""
    return f"(instr({text}, '@') = 0 or instr(substring_index({text}, '@', -1), '.') = 0)"


def matches(text: str, pattern: str) -> str:
    return f"{text} rlike {lit(pattern)}"
