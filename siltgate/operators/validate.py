"""Apply a rule set to a DataFrame: accepted rows, error rows, a summary.

A chain of projections and no shuffle: kind and text of each field, intermediate
results, rules. Keeping them apart lets each expression be computed once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions import variants as v
from siltgate.functions.text import lit, name, words
from siltgate.operators.rules import CELL_PREFIX, Cell, Rule
from siltgate.operators.rulesets import FieldRule, RuleSet
from siltgate.session import counted

RECORD_ERROR_FIELD = "__batch__"
RECORD_ERROR_CODE = "unexpected_exception"
# The cell that stands for the document as a whole.
WHOLE = "_whole"
# How values that count as empty are shown.
EMPTY_TEXTS = ("", "0", "0.0", "-0.0", "false", "False", "[]", "{}")


@dataclass(frozen=True)
class Validation:
    """``checked`` holds every input row with its typed ``record`` and its ``errors``."""

    checked: DataFrame
    rule_set: RuleSet

    @property
    def accepted(self) -> DataFrame:
        return self.checked.filter("size(errors) = 0").drop("errors")

    @property
    def rejected(self) -> DataFrame:
        return error_rows(self.checked)

    @property
    def summary(self) -> DataFrame:
        return validation_summary(self.checked)


def error_rows(checked: DataFrame) -> DataFrame:
    """One row per error; ``context`` holds the text that failed."""
    kept = [name(c) for c in checked.columns if c not in ("errors", "record")]
    return checked.selectExpr(*kept, "explode(errors) as error").selectExpr(
        *kept,
        "error.field_name",
        "error.message",
        "error.error_code",
        "case when error.input is not null then map('input', error.input) end as context",
    )


def _paths(rule_set: RuleSet) -> dict[str, tuple[str, ...]]:
    """Every field to read and its path: the declared ones and those ids come from."""
    paths = {f.name: f.keys for f in rule_set.fields}
    for extra in rule_set.id_fields:
        paths.setdefault(extra, (extra,))
    return paths


def _object_keys(paths: Iterable[tuple[str, ...]]) -> dict[tuple[str, ...], list[str]]:
    """The keys to read from each nested object, outer objects first."""
    keys: dict[tuple[str, ...], list[str]] = {(): []}
    for path in paths:
        for depth in range(len(path)):
            wanted = keys.setdefault(path[:depth], [])
            if path[depth] not in wanted:
                wanted.append(path[depth])
    return dict(sorted(keys.items(), key=lambda item: len(item[0])))


def _first_parts(cell: Cell) -> list[str]:
    """What a cell starts with. The VARIANT is carried only for rules that look at it."""
    used = any(cell.raw in e for e in (cell.layers[0].values() if cell.layers else []))
    return ["raw", "kind", "text"] if cell.document and used else ["kind", "text"]


def _document_cells(
    df: DataFrame, rule_set: RuleSet, document: str, keep: list[str], cells: dict[str, Cell]
) -> DataFrame:
    """Every object is opened once, as a struct of its fields; then each field's kind and text."""
    fields = _paths(rule_set)
    objects = _object_keys([*fields.values(), *rule_set.object_paths])

    def column(kind: str, path: tuple[str, ...]) -> str:
        return name("_".join([kind, *path]))

    opened: list[str] = []
    for path, keys in objects.items():
        holder = f"{column('_values', path[:-1])}.{name(path[-1])}" if path else name(document)

        def struct(sql_type: str, wanted: list[str]) -> str:
            return lit("struct<" + ", ".join(f"{name(k)}: {sql_type}" for k in wanted) + ">")

        values = f"try_variant_get({holder}, '$', {struct('variant', keys)}) as {column('_values', path)}"
        texts = f"try_variant_get({holder}, '$', {struct('string', keys)}) as {column('_texts', path)}"
        whole = WHOLE if path else f"{name(document)} as {WHOLE}"
        df = df.selectExpr(*keep, *opened, whole, values, texts)
        opened += [column("_values", path), column("_texts", path)]

    def cell(n: str, path: tuple[str, ...], raw: bool) -> str:
        value = f"{column('_values', path[:-1])}.{name(path[-1])}"
        text = f"{column('_texts', path[:-1])}.{name(path[-1])}"
        raw_part = f"'raw', {value}, " if raw else ""
        return f"named_struct({raw_part}'kind', {v.kind(value)}, 'text', {text}) as {CELL_PREFIX}{n}"

    return df.selectExpr(
        *keep,
        *[cell(n, path, "raw" in _first_parts(cells[n])) for n, path in fields.items()],
        *[cell(_part(path), path, False) for path in rule_set.object_paths],
        f"named_struct('kind', {v.kind(WHOLE)}) as {CELL_PREFIX}{WHOLE}",
    )


def _part(path: tuple[str, ...]) -> str:
    return "_part_" + "_".join(path)


def _column_cells(
    df: DataFrame, rule_set: RuleSet, keep: list[str], null_is_missing: bool
) -> DataFrame:
    """String columns as cells; a column the frame lacks is a missing field."""

    def cell(n: str) -> str:
        known = n in df.columns
        text = f"cast({name(n) if known else 'null'} as string)"
        empty = v.NULL if known and not null_is_missing else v.MISSING
        kind = f"case when {text} is null then '{empty}' else '{v.TEXT}' end"
        return f"named_struct('kind', {kind}, 'text', {text}) as {CELL_PREFIX}{n}"

    return df.selectExpr(*keep, *[cell(n) for n in _paths(rule_set)])


def _with_lets(frame: DataFrame, cells: dict[str, Cell], keep: list[str]) -> DataFrame:
    """One projection per layer of intermediate results."""
    others = [c for c in frame.columns if c.removeprefix(CELL_PREFIX) not in cells and c not in keep]
    known = {n: _first_parts(c) for n, c in cells.items()}
    for depth in range(max((len(c.layers) for c in cells.values()), default=0)):
        columns = []
        for n, c in cells.items():
            column = f"{CELL_PREFIX}{n}"
            added = c.layers[depth] if len(c.layers) > depth else {}
            if added or (depth == 0 and "raw" in known[n]):
                known[n] = [k for k in known[n] if k != "raw"]
                parts = [f"'{k}', {column}.{k}" for k in known[n]]
                parts += [f"'{k}', {e}" for k, e in added.items()]
                columns.append(f"named_struct({', '.join(parts)}) as {column}")
                known[n] += added
            else:
                columns.append(column)
        frame = frame.selectExpr(*keep, *others, *columns)
    return frame


def _unreadable(rule_set: RuleSet) -> list[str]:
    """Crash text for a document, or a nested part, that is no object."""

    def complaint(kind: str) -> str:
        python_name = (
            f"case {kind} when '{v.LIST}' then 'list' when '{v.TEXT}' then 'str'"
            f" when '{v.INT}' then 'int' when '{v.BOOL}' then 'bool' when '{v.DECIMAL}' then 'float'"
            f" when '{v.DOUBLE}' then 'float' else 'NoneType' end"
        )
        return f"concat('\\'', {python_name}, '\\' object has no attribute \\'get\\'')"

    whole = f"{CELL_PREFIX}{WHOLE}.kind"
    reasons = [f"case when {whole} != '{v.OBJECT}' then {complaint(whole)} end"]
    for path in rule_set.object_paths:
        kind, text = (f"{CELL_PREFIX}{_part(path)}.{k}" for k in ("kind", "text"))
        usable = f"{kind} in {words((v.MISSING, v.NULL, v.OBJECT))} or {text} in {words(EMPTY_TEXTS)}"
        reasons.append(f"case when not ({usable}) then {complaint(kind)} end")
    return reasons


def _record_id(cells: dict[str, Cell], values: dict[str, str], rule_set: RuleSet) -> str:
    if rule_set.id_from_value:
        cell = cells[rule_set.id_fields[0]]
        shown = f"case when not {cell.missing} then {cell.shown()} end"
        return f"coalesce(cast({values[cell.name]} as string), {shown}, 'unknown')"

    def truthy(cell: Cell) -> str:
        zero = f"{cell.kind} != '{v.TEXT}' and {cell.text} in {words(EMPTY_TEXTS)}"
        return f"case when not ({cell.absent} or {cell.text} = '' or ({zero})) then {cell.shown()} end"

    return f"coalesce({', '.join(truthy(cells[n]) for n in rule_set.id_fields)}, 'unknown')"


def validate(
    df: DataFrame,
    rule_set: RuleSet,
    run_ts: datetime,
    document: str | None = None,
    carry: Sequence[str] = (),
    null_is_missing: bool = False,
) -> Validation:
    """Check every row of ``df``.

    ``document`` names a VARIANT column; without it the fields are string
    columns. ``record_id`` and ``source_name`` columns are used where present.
    ``carry`` columns pass through. With ``null_is_missing`` a NULL column value
    means that the source had no such field.
    """
    carried = [name(c) for c in carry if c not in ("record_id", "source_name")]
    given = "cast(record_id as string)" if "record_id" in df.columns else "cast(null as string)"
    source = "coalesce(source_name, 'unknown')" if "source_name" in df.columns else "'unknown'"
    df = df.selectExpr("*", f"{given} as _given", f"{source} as _source")
    keep = [*carried, "_given", "_source"]
    cells = {n: Cell(n, document is not None) for n in _paths(rule_set)}
    crashes = _unreadable(rule_set) if document is not None else ["cast(null as string)"]
    outcomes = {f.name: f.rule(cells[f.name]) for f in rule_set.fields}
    values = {n: o.value for n, o in outcomes.items()}
    cases = {n: list(o.cases) for n, o in outcomes.items()}
    crashes += [o.crash for o in outcomes.values() if o.crash is not None]
    for cross in rule_set.cross:
        field, outcome = cross(cells)
        cases[field] += outcome.cases
        crashes += [outcome.crash] if outcome.crash is not None else []
    known_id = _record_id(cells, values, rule_set)
    if document is not None:
        frame = _document_cells(df, rule_set, document, keep, cells)
    else:
        frame = _column_cells(df, rule_set, keep, null_is_missing)
    frame = _with_lets(frame, cells, keep)
    frame = frame.selectExpr("*", f"coalesce({', '.join(crashes)}) as _crash")

    def error(field: str) -> str:
        whens = [
            f"when {condition} then "
            + _error_row(field, found.message, found.code, cells[field].text)
            for condition, found in cases[field]
        ]
        return f"case {' '.join(whens)} end"

    field_errors = f"array_compact(array({', '.join(error(n) for n in outcomes if cases[n])}))"
    crash_error = _error_row(RECORD_ERROR_FIELD, "_crash", RECORD_ERROR_CODE, "cast(null as string)")
    # A record that crashed is known only by the id its envelope gave.
    found_id = f"case when _crash is not null then 'unknown' else {known_id} end"
    if not rule_set.id_from_value:
        found_id = f"coalesce(nullif(_given, ''), {found_id})"
    typed = ", ".join(f"'{n}', {value}" for n, value in values.items())
    checked = frame.selectExpr(
        *carried,
        f"{found_id} as record_id",
        "_source as source_name",
        f"{lit(rule_set.source_type)} as source_type",
        f"{lit(rule_set.version)} as schema_version",
        f"{lit(run_ts.isoformat())} as validated_at",
        f"named_struct({typed}) as record",
        f"case when _crash is not null then array({crash_error}) else {field_errors} end as errors",
    )
    checked = counted(
        checked,
        f"validation {rule_set.source_type}",
        processed="count(1)",
        accepted="count_if(size(errors) = 0)",
        errors="sum(size(errors))",
    )
    return Validation(checked, rule_set)


def apply_rule(df: DataFrame, field: str, rule: Rule, document: str | None = None) -> DataFrame:
    """One rule on one field: ``df`` plus ``value``, ``error_code`` and ``crash``."""
    rule_set = RuleSet("", "", (FieldRule(field, rule),), id_fields=(field,))
    keep = [name(c) for c in df.columns]
    cell = Cell(field, document is not None)
    outcome = rule(cell)
    if document is not None:
        frame = _document_cells(df, rule_set, document, keep, {field: cell})
    else:
        frame = _column_cells(df, rule_set, keep, False)
    frame = _with_lets(frame, {field: cell}, keep)
    whens = " ".join(f"when {condition} then {lit(found.code)}" for condition, found in outcome.cases)
    return frame.selectExpr(
        *keep,
        f"{outcome.value} as value",
        f"{f'case {whens} end' if whens else 'cast(null as string)'} as error_code",
        f"{outcome.crash or 'cast(null as string)'} as crash",
    )


def _error_row(field: str, message: str, code: str, text: str) -> str:
    return (
        f"named_struct('field_name', {lit(field)}, 'message', {message},"
        f" 'error_code', {lit(code)}, 'input', {text})"
    )


def validation_summary(checked: DataFrame, order: str | None = None) -> DataFrame:
    """One row of counts. ``rejected`` counts errors, ``rejected_records`` records.

    ``source_name`` is that of the first accepted record in ``order``, else of
    the first rejected one. Only partial aggregates are shuffled.
    """

    def first_source(condition: str) -> str:
        if order is None:
            return f"first(source_name, true) filter (where {condition})"
        return f"min_by(source_name, {name(order)}) filter (where {condition})"

    good, bad = "size(errors) = 0", "size(errors) > 0"
    errors = "coalesce(sum(size(errors)), 0L)"
    return checked.selectExpr(
        f"coalesce({first_source(good)}, {first_source(bad)}, 'unknown') as source_name",
        "max(source_type) as source_type",
        "max(schema_version) as schema_version",
        "count(1) as processed",
        f"count_if({good}) as accepted",
        f"{errors} as rejected",
        "0L as skipped",
        f"{errors} as errors",
        f"count_if({bad}) as rejected_records",
        "max(validated_at) as validated_at",
    )


def error_counts(checked: DataFrame) -> DataFrame:
    """Errors by field and code."""
    found = checked.selectExpr("explode(errors) as error")
    return found.groupBy(
        F.col("error.field_name").alias("field_name"), F.col("error.error_code").alias("error_code")
    ).agg(F.count("*").alias("n"))


def closed(df: DataFrame, rule_set: RuleSet) -> DataFrame:
    """Only the fields the rule set declares."""
    return df.select(*[F.col(name(n)) for n in rule_set.names if n in df.columns])
