"""Field rules: a cell in, a coerced value and the cases that are problems out.

Rules write SQL text, so a whole rule set becomes a few projections of built-in
functions; no Python touches the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from siltgate.fixed_values import (
    ACTIVE_FALSE,
    ACTIVE_TRUE,
    MESSAGES,
    OPT_IN_FALSE,
    OPT_IN_TRUE,
    STATUSES,
    STRICT_EMAIL_ERROR,
    STRICT_FALSE,
    STRICT_TRUE,
    VALUE_ERRORS,
)
from siltgate.functions import moments, numbers
from siltgate.functions import variants as v
from siltgate.functions.text import lit, malformed_email, matches, quoted, strip, words

# Each field travels through the projections as one struct column.
CELL_PREFIX = "_cell_"


@dataclass(frozen=True)
class Cell:
    """One raw field: its kind (see functions.variants), its text, and the VARIANT if it has one.

    ``let`` names an intermediate result. It becomes part of a projection below
    the rules, so that a rule may use it many times while it is computed once;
    without that, nested uses multiply the generated code. ``raw`` is there for
    the first layer only; the copies of later layers stay small without it.
    """

    name: str
    document: bool
    layers: list[dict[str, str]] = field(default_factory=list)

    def part(self, label: str) -> str:
        return f"{CELL_PREFIX}{self.name}.{label}"

    @property
    def kind(self) -> str:
        return self.part("kind")

    @property
    def text(self) -> str:
        return self.part("text")

    @property
    def raw(self) -> str:
        return self.part("raw")

    def let(self, label: str, result: str, layer: int = 0) -> str:
        while len(self.layers) <= layer:
            self.layers.append({})
        self.layers[layer][label] = result
        return self.part(label)

    def is_kind(self, *kinds: str) -> str:
        return f"{self.kind} in {words(kinds)}"

    @property
    def missing(self) -> str:
        return self.is_kind(v.MISSING)

    @property
    def absent(self) -> str:
        """Missing or null."""
        return self.is_kind(v.MISSING, v.NULL)

    def _python_text(self) -> str:
        return v.python_text(self.raw, self.kind, self.text) if self.document else self.text

    def _shown(self) -> str:
        return f"case when {self.is_kind(v.NULL)} then 'None' else {self._python_text()} end"

    def shown(self) -> str:
        """The value as Python's str() shows it, ``None`` for null."""
        return self.let("shown", self._shown())

    def shown_stripped(self) -> str:
        return self.let("shown_stripped", strip(f"({self._shown()})"))

    def stripped(self) -> str:
        """Any value as stripped text."""
        return self.let("stripped", strip(f"({self._python_text()})"))

    def as_float(self) -> str:
        """double of a number or of text; only text needs checking."""
        numeric = self.is_kind(v.INT, v.DECIMAL, v.DOUBLE)
        checked = numbers.float_from_text(self.text)
        if not self.document:
            return checked
        return f"case when {numeric} then try_cast({self.text} as double) else {checked} end"

    def number(self) -> str:
        return self.let("number", self.as_float())


@dataclass(frozen=True)
class Problem:
    code: str
    message: str


@dataclass(frozen=True)
class Outcome:
    """The coerced value; the first case that holds is the field's problem.

    ``crash`` is a text that voids the whole record, or NULL.
    """

    value: str
    cases: Sequence[tuple[str, Problem]] = ()
    crash: str | None = None


Rule = Callable[[Cell], Outcome]


def problem(code: str, **sizes: object) -> Problem:
    return Problem(code, lit(MESSAGES[code].format(**sizes)))


def value_error(message: str, got: str | None = None) -> Problem:
    text = lit("Value error, " + message)
    return Problem("value_error", f"concat({text}, {got})" if got else text)


def _too_short(length: int) -> Problem:
    return problem("string_too_short", n=length, s="" if length == 1 else "s")


def _below(minimum: int) -> Problem:
    return problem("greater_than_equal", n=minimum)


MISSING = problem("missing")


def absent_as_null(rule: Rule) -> Rule:
    """A flattened document passes an absent key on as null, so it is never "missing"."""

    def wrapped(cell: Cell) -> Outcome:
        outcome = rule(cell)
        cases = [case for case in outcome.cases if case[1] is not MISSING]
        return Outcome(outcome.value, cases, outcome.crash)

    return wrapped


# --- text -------------------------------------------------------------------


def required_text(cell: Cell) -> Outcome:
    """A string of at least one character, kept as it is."""
    return Outcome(
        cell.text,
        [
            (cell.missing, MISSING),
            (f"not {cell.is_kind(v.TEXT)}", problem("string_type")),
            (f"{cell.text} = ''", _too_short(1)),
        ],
    )


def optional_text(cell: Cell) -> Outcome:
    allowed = cell.is_kind(v.TEXT, v.NULL, v.MISSING)
    return Outcome(cell.text, [(f"not {allowed}", problem("string_type"))])


def any_as_text(cell: Cell) -> Outcome:
    """Any value as stripped text; null becomes the word None."""
    value = cell.shown_stripped()
    return Outcome(value, [(cell.missing, MISSING), (f"{value} = ''", _too_short(1))])


def stripped_text(cell: Cell) -> Outcome:
    """Any non-null value as stripped text of at least one character."""
    value = cell.stripped()
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (cell.absent, value_error(VALUE_ERRORS["null"])),
            (f"{value} = ''", _too_short(1)),
        ],
    )


def non_blank(cell: Cell) -> Outcome:
    value = cell.stripped()
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (cell.absent, value_error(VALUE_ERRORS["required"].format(field=cell.name))),
            (f"{value} = ''", value_error(VALUE_ERRORS["blank"].format(field=cell.name))),
        ],
    )


def text_of_length(length: int) -> Rule:
    """A string that still has ``length`` characters after strip."""

    def rule(cell: Cell) -> Outcome:
        value = cell.let("value", strip(cell.text))
        return Outcome(
            value,
            [
                (cell.missing, MISSING),
                (f"not {cell.is_kind(v.TEXT)}", problem("string_type")),
                (f"length({value}) < {length}", _too_short(length)),
            ],
        )

    return rule


def email(hint: str = "") -> Rule:
    def rule(cell: Cell) -> Outcome:
        value = cell.stripped()
        return Outcome(
            value,
            [
                (cell.missing, MISSING),
                (cell.absent, value_error(VALUE_ERRORS["required"].format(field="email"))),
                (f"{value} = ''", value_error(VALUE_ERRORS["blank"].format(field="email"))),
                (malformed_email(value), value_error(VALUE_ERRORS["email"].format(hint=hint), quoted(value))),
            ],
        )

    return rule


# Fixed pattern for the strict rule set: dot-atom local part, dotted domain.
STRICT_EMAIL = (
    r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
    r"@([A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z][A-Za-z0-9-]{0,61}[A-Za-z0-9]$"
)


def strict_email(cell: Cell) -> Outcome:
    value = cell.let("value", strip(cell.text))
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (f"not {cell.is_kind(v.TEXT)}", problem("string_type")),
            (
                f"not ({matches(value, STRICT_EMAIL)})",
                Problem("value_error", lit(STRICT_EMAIL_ERROR)),
            ),
        ],
    )


def optional_phone(cell: Cell) -> Outcome:
    value = cell.stripped()
    return Outcome(f"case when not {cell.absent} then nullif({value}, '') end")


def status(cell: Cell) -> Outcome:
    value = f"lower({cell.shown_stripped()})"
    allowed = ", ".join(f"'{s}'" for s in STATUSES)
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (
                f"{value} not in {words(STATUSES)}",
                value_error(VALUE_ERRORS["status"].format(allowed=allowed), quoted(value)),
            ),
        ],
    )


# --- booleans ---------------------------------------------------------------


def _word_flag(word: str, true: Sequence[str], false: Sequence[str]) -> str:
    return f"case when {word} in {words(true)} then true when {word} in {words(false)} then false end"


def opt_in(cell: Cell) -> Outcome:
    """yes/no words in any case; blank is unknown."""
    word = cell.let("word", f"lower({strip(cell.text)})")
    value = _word_flag(word, OPT_IN_TRUE, OPT_IN_FALSE)
    unknown = f"not {cell.absent} and {word} not in {words(('', *OPT_IN_TRUE, *OPT_IN_FALSE))}"
    message = VALUE_ERRORS["opt_in"].format(field=cell.name)
    return Outcome(value, [(unknown, value_error(message, quoted(cell.text)))])


def active_flag(cell: Cell) -> Outcome:
    """A boolean, any int (0 is false), or one of a few words."""
    word = f"lower({cell.shown_stripped()})"
    value = cell.let(
        "value",
        f"case when {cell.is_kind(v.INT)} then cast({cell.text} as bigint) != 0"
        f" else {_word_flag(word, ACTIVE_TRUE, ACTIVE_FALSE)} end",
        layer=1,
    )
    got = f"case when {cell.is_kind(v.TEXT)} then {quoted(cell.text)} else {cell.shown()} end"
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (f"{value} is null", value_error(VALUE_ERRORS["active"], got)),
        ],
    )


def strict_bool(cell: Cell) -> Outcome:
    word = cell.let("word", f"lower({cell.text})")
    number = cell.number()
    value = cell.let(
        "value",
        f"case when {cell.is_kind(v.INT, v.DECIMAL, v.DOUBLE)} then"
        f" case when {number} = 1 then true when {number} = 0 then false end"
        f" when {cell.is_kind(v.TEXT, v.BOOL)} then {_word_flag(word, STRICT_TRUE, STRICT_FALSE)} end",
        layer=1,
    )
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (f"{value} is null and {cell.is_kind(v.TEXT, v.INT)}", problem("bool_parsing")),
            (f"{value} is null", problem("bool_type")),
        ],
    )


# --- dates ------------------------------------------------------------------


def _date_text(cell: Cell) -> str:
    """What a date is read from: the shown text, or an exported date."""
    shown = cell.shown_stripped()
    if not cell.document:
        return shown
    exported = cell.let("exported", f"case when {cell.is_kind(v.OBJECT)} then {v.exported_date(cell.raw)} end")
    return f"coalesce({exported}, {shown})"


def _moment(cell: Cell, text: str, layer: int = 1) -> str:
    """struct<at, zoned, shown> or NULL. ``iso``, ``offset`` and ``at`` are parts of the cell."""
    spelled = cell.let("spelled", moments.spelled(text), layer)
    iso = cell.let("iso", moments.when_iso(spelled), layer + 1)
    offset = cell.let("offset", moments.offset_of(iso), layer + 2)
    clock = moments.clock_of(iso, offset)
    at = cell.let("at", moments.instant(iso, clock, offset), layer + 3)
    return (
        f"case when {at} is not null then named_struct('at', {at}, 'zoned', {offset} != '',"
        f" 'shown', {moments.shown(iso, clock, offset)}) end"
    )


def iso_date(cell: Cell) -> Outcome:
    shown = _date_text(cell)
    exported = f"case when {cell.is_kind(v.OBJECT)} then substring({shown}, 1, 10) else {shown} end"
    value = cell.let("value", moments.iso_date(f"({exported})" if cell.document else shown), layer=1)
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (
                f"{value} is null",
                value_error(VALUE_ERRORS["date"].format(field=cell.name), quoted(shown)),
            ),
        ],
    )


def iso_moment(cell: Cell) -> Outcome:
    shown = _date_text(cell)
    value = _moment(cell, shown)
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (
                f"{cell.part('at')} is null",
                value_error(VALUE_ERRORS["moment"], quoted(shown)),
            ),
        ],
    )


def optional_moment(cell: Cell) -> Outcome:
    """ISO date-time, NULL when it cannot be read."""
    return Outcome(_moment(cell, cell.text, layer=0))


def strict_date(cell: Cell) -> Outcome:
    """ISO date, or a date-time at midnight."""
    _moment(cell, cell.text, layer=0)
    at = cell.part("at")
    clock = moments.clock_of(cell.part("iso"), cell.part("offset"))
    value = f"case when {clock} = {lit(moments.MIDNIGHT)} then cast(substring({cell.part('iso')}, 1, 10) as date) end"
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (f"not {cell.is_kind(v.TEXT)}", problem("date_type")),
            (f"{at} is null", problem("date_from_datetime_parsing")),
            (f"{clock} != {lit(moments.MIDNIGHT)}", problem("date_from_datetime_inexact")),
        ],
    )


def strict_moment(cell: Cell) -> Outcome:
    value = _moment(cell, cell.text, layer=0)
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (f"not {cell.is_kind(v.TEXT)}", problem("datetime_type")),
            (f"{cell.part('at')} is null", problem("datetime_from_date_parsing")),
        ],
    )


# --- numbers ----------------------------------------------------------------

FLOATS = (v.DECIMAL, v.DOUBLE)
NO_INFINITY = lit("cannot convert float infinity to integer")


def age(cell: Cell) -> Outcome:
    """Whole years, leniently; an infinite age voids the record."""
    number = cell.number()
    infinite = numbers.is_infinite(number)
    return Outcome(
        numbers.age_of(number), crash=f"case when {infinite} then {NO_INFINITY} end"
    )


def _flag_as(cell: Cell, one: str, zero: str) -> str:
    return f"case when {cell.text} = 'true' then {one} else {zero} end"


def positive_int(cell: Cell) -> Outcome:
    """An int of at least 1; whole floats, numeric text and booleans count as ints."""
    number = cell.number()
    value = cell.let(
        "value",
        f"case {cell.kind} when '{v.INT}' then cast({cell.text} as bigint)"
        f" when '{v.BOOL}' then {_flag_as(cell, '1L', '0L')}"
        f" when '{v.TEXT}' then {numbers.lax_int_from_text(cell.text)}"
        f" else case when {number} % 1 = 0 then {numbers.truncated(number)} end end",
        layer=1,
    )
    shaped = matches(strip(cell.text), numbers.INT_OR_ZERO_FRACTION)
    return Outcome(
        value,
        [
            (cell.missing, MISSING),
            (cell.is_kind(v.MISSING, v.NULL, v.LIST, v.OBJECT), problem("int_type")),
            (f"{value} < 1", _below(1)),
            (f"{value} is null and {cell.is_kind(v.TEXT)} and not ({shaped})", problem("int_parsing")),
            (f"{numbers.is_infinite(number)} and {cell.is_kind(*FLOATS)}", problem("finite_number")),
            (f"{value} is null and {number} % 1 != 0", problem("int_from_float")),
            (f"{value} is null", problem("int_parsing_size")),
        ],
    )


def lenient_float(cell: Cell) -> Outcome:
    """double, NULL when it cannot be read."""
    flag = _flag_as(cell, "1D", "0D")
    value = f"case when {cell.is_kind(v.BOOL)} then {flag} else {cell.as_float()} end"
    return Outcome(cell.let("value", value))


def required_float(cell: Cell) -> Outcome:
    """double of at least 0. NaN fails; Spark would order it above every number."""
    value = lenient_float(cell).value
    return Outcome(
        value,
        [
            (f"{value} is null", problem("float_type")),
            (f"isnan({value}) or {value} < 0", _below(0)),
        ],
    )


def lenient_int(cell: Cell) -> Outcome:
    """bigint: floats are truncated, text must be a whole number, the rest is NULL."""
    number = cell.number()
    value = cell.let(
        "value",
        f"case {cell.kind} when '{v.BOOL}' then {_flag_as(cell, '1L', '0L')}"
        f" when '{v.DECIMAL}' then {numbers.truncated(number)}"
        f" when '{v.DOUBLE}' then {numbers.truncated(number)}"
        f" else {numbers.int_from_text(cell.text)} end",
        layer=1,
    )
    infinite = f"{numbers.is_infinite(number)} and {cell.is_kind(*FLOATS)}"
    return Outcome(value, crash=f"case when {infinite} then {NO_INFINITY} end")


def required_count(cell: Cell) -> Outcome:
    base = lenient_int(cell)
    cases = [
        (f"{base.value} is null", problem("int_type")),
        (f"{base.value} < 0", _below(0)),
    ]
    return Outcome(base.value, cases, base.crash)


# --- lists ------------------------------------------------------------------


def tag_list(cell: Cell) -> Outcome:
    """struct<items array<string>, fault string>.

    Null gives no items, a scalar one item. ``fault`` names the first item that
    is not a string; such a list passes here but cannot be joined later.
    """
    elements = cell.let("items", f"case when {cell.is_kind(v.LIST)} then {v.items(cell.raw)} end")
    kinds = cell.let("kinds", f"transform({elements}, e -> {v.kind('e')})", layer=1)
    odd = cell.let("odd", f"array_position(transform({kinds}, k -> k != '{v.TEXT}'), true) - 1", layer=2)
    odd_name = (
        f"case get({kinds}, int({odd})) when '{v.NULL}' then 'NoneType' when '{v.INT}' then 'int'"
        f" when '{v.BOOL}' then 'bool' when '{v.LIST}' then 'list' when '{v.OBJECT}' then 'dict'"
        " else 'float' end"
    )
    fault = f"concat('sequence item ', {odd}, ': expected str instance, ', {odd_name}, ' found')"
    return Outcome(
        f"named_struct('items', case when {cell.absent} then cast(array() as array<string>)"
        f" when {elements} is not null then transform({elements}, e -> {v.plain_text('e')})"
        f" else array({cell.shown()}) end,"
        f" 'fault', case when {odd} >= 0 then {fault} end)"
    )
