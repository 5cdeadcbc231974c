"""Numbers written as text, read the way Python's int() and float() read them."""

from __future__ import annotations

from siltgate.fixed_values import MAX_AGE
from siltgate.functions.text import lit, matches, strip

# Fixed patterns: digits may be grouped by single underscores.
INT_TEXT = r"^[+-]?\d+(_\d+)*$"
INT_OR_ZERO_FRACTION = r"^[+-]?\d+(_\d+)*(\.0+)?$"
FLOAT_TEXT = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
# Fixed words for what float() reads besides digits.
INFINITY = ("inf", "infinity", "+inf", "+infinity")
MINUS_INFINITY = ("-inf", "-infinity")
NOT_A_NUMBER = ("nan", "+nan", "-nan")


def _as(text: str, sql_type: str) -> str:
    return f"try_cast(replace({text}, '_', '') as {sql_type})"


def is_int_text(text: str) -> str:
    """True for text that int() accepts."""
    return matches(strip(text), INT_TEXT)


def int_from_text(text: str, sql_type: str = "bigint") -> str:
    """The int for text that int() accepts, NULL for other text or when too wide."""
    return f"case when {is_int_text(text)} then {_as(strip(text), sql_type)} end"


def lax_int_from_text(text: str) -> str:
    """As int_from_text, also taking a fraction of zeros ("5.0")."""
    whole = f"regexp_replace({strip(text)}, {lit(r'\.0+$')}, '')"
    return f"case when {matches(strip(text), INT_OR_ZERO_FRACTION)} then {_as(whole, 'bigint')} end"


def float_from_text(text: str) -> str:
    """double for text that float() accepts, infinities and NaN included."""
    low = f"lower({strip(text)})"

    def one_of(words: tuple[str, ...]) -> str:
        return f"{low} in ({', '.join(lit(w) for w in words)})"

    return (
        f"case when {matches(strip(text), FLOAT_TEXT)} then {_as(strip(text), 'double')}"
        f" when {one_of(INFINITY)} then double('Infinity')"
        f" when {one_of(MINUS_INFINITY)} then double('-Infinity')"
        f" when {one_of(NOT_A_NUMBER)} then double('NaN') end"
    )


def is_infinite(number: str) -> str:
    return f"abs({number}) = double('Infinity')"


def truncated(number: str) -> str:
    """Whole part toward zero as bigint; NULL for NaN, infinities and overflow."""
    return f"case when abs({number}) < 9.2e18D then try_cast({number} as bigint) end"


def age_of(number: str) -> str:
    """Whole years as int: truncated, NULL when not a number or outside 1..150."""
    inside = f"{number} >= 1 and {number} < {MAX_AGE + 1}"
    return f"case when {inside} then try_cast({number} as int) end"


def age_from_text(text: str) -> str:
    return age_of(f"({float_from_text(text)})")
