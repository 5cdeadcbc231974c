"""Several versions of a source's records in one batch, and rule sets kept as rows of a table.

Each row goes to the rule set of its own version; a row of a version nobody registered is an
error, and the others go on. A rule table has one row per field: which rule set it belongs to, its
place, its rule by name, and where a document keeps it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.fixed_values import DEFAULT_VERSION
from siltgate.functions.text import lit, name
from siltgate.operators import rules
from siltgate.operators.rules import Rule
from siltgate.operators.rulesets import CrossRule, FieldRule, Registry, RuleSet, updated_after_created
from siltgate.operators.validate import RECORD_ERROR_CODE, RECORD_ERROR_FIELD, Validation, validate
from siltgate.session import new_path

# ``kind``: field; cross (``rule`` names a rule over several fields); object (``path`` must hold an
# object); id (``field`` is one a record's id is taken from, in the order of ``position``).
RULE_TABLE = "source_type string, version string, kind string, position int, field string, rule string, path string"

# Rules by name. Those that take a word or a number are written name:value.
RULES: dict[str, Rule] = {
    rule.__name__: rule
    for rule in (
        rules.required_text, rules.optional_text, rules.any_as_text, rules.stripped_text, rules.non_blank,
        rules.strict_email, rules.optional_phone, rules.status, rules.opt_in, rules.active_flag, rules.strict_bool,
        rules.iso_date, rules.iso_moment, rules.optional_moment, rules.strict_date, rules.strict_moment, rules.age,
        rules.positive_int, rules.lenient_float, rules.required_float, rules.lenient_int, rules.required_count,
        rules.tag_list,
    )
}
RULES_WITH: dict[str, Callable[[str], Rule]] = {
    "text_of_length": lambda value: rules.text_of_length(int(value)),
    "email": rules.email,
    "absent_as_null": lambda value: rules.absent_as_null(rule_named(value)),
}
CROSS_RULES: dict[str, CrossRule] = {"updated_after_created": updated_after_created}


def rule_named(text: str) -> Rule:
    """The rule a table names: ``positive_int``, ``text_of_length:7``, ``absent_as_null:positive_int``."""
    word, _, value = text.partition(":")
    if word in RULES_WITH:
        return RULES_WITH[word](value)
    if text not in RULES:
        raise ValueError(f"no rule is named {text!r}")
    return RULES[text]


def register_rule_table(registry: Registry, table: DataFrame) -> Registry:
    """Add the rule sets of a rule table: settings, a few rows per field and version."""
    rows = table.orderBy("source_type", "version", "position").collect()
    for key in dict.fromkeys((r["source_type"], r["version"]) for r in rows):
        mine = [r for r in rows if (r["source_type"], r["version"]) == key]
        fields, crosses, objects, ids = ([r for r in mine if r["kind"] == kind] for kind in ("field", "cross", "object", "id"))
        if not fields or len(fields) + len(crosses) + len(objects) + len(ids) != len(mine):
            raise ValueError(f"rule set {key}: kinds are field, cross, object and id, and there must be a field")
        for r in crosses:
            if r["rule"] not in CROSS_RULES:
                raise ValueError(f"no cross rule is named {r['rule']!r}")
        own_ids = {"id_fields": tuple(r["field"] for r in ids)} if ids else {}
        rule_set = RuleSet(
            *key,
            tuple(FieldRule(r["field"], rule_named(r["rule"]), _path(r["path"])) for r in fields),
            tuple(CROSS_RULES[r["rule"]] for r in crosses),
            tuple(_path(r["path"]) for r in objects),
            **own_ids,
        )
        registry.register(*key, rule_set)
    return registry


def _path(text: str | None) -> tuple[str, ...]:
    return tuple(text.split(".")) if text else ()


@dataclass(frozen=True)
class VersionedValidation:
    """``by_version``: each version's rows under its own rule set. ``unknown``: rows of no
    registered version, checked in name only: no ``record``, one error."""

    by_version: dict[str, Validation]
    unknown: DataFrame

    @property
    def checked(self) -> DataFrame:
        """All rows, without their records, whose fields differ from version to version."""
        frames = [v.checked.drop("record") for v in self.by_version.values()] + [self.unknown]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out


def validate_versions(
    df: DataFrame,
    registry: Registry,
    source_type: str,
    run_ts: datetime,
    version_column: str = "schema_version",
    document: str | None = None,
    carry: Sequence[str] = (),
    null_is_missing: bool = False,
) -> VersionedValidation:
    """Check every row by the rule set of its version; rows that name none are of the default one.

    The rows are staged once, by version, so that each rule set reads its own alone.
    """
    known = registry.available_versions(source_type)
    if not known:
        raise ValueError(f"unknown source type: {source_type}")
    version = F.coalesce(F.col(name(version_column)).cast("string"), F.lit(DEFAULT_VERSION))
    others = [name(c) for c in df.columns if c != version_column]
    rows = df.select(*others, version.alias("_version"))
    place = F.coalesce(*[F.when(F.col("_version") == v, F.lit(i)) for i, v in enumerate(known)], F.lit(-1))
    path = new_path(df.sparkSession, f"versions-{source_type}")
    rows.withColumn("silt_rule_set", place).write.partitionBy("silt_rule_set").parquet(path)
    staged = df.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField("silt_rule_set", T.IntegerType())])).parquet(path)

    def part(number: int) -> DataFrame:
        return staged.where(F.col("silt_rule_set") == number).drop("silt_rule_set")

    checked = {
        v: validate(part(i).drop("_version"), registry.resolve(source_type, v), run_ts, document, carry, null_is_missing)
        for i, v in enumerate(known)
    }
    return VersionedValidation(checked, _of_no_version(part(-1), source_type, run_ts, carry))


def _of_no_version(rows: DataFrame, source_type: str, run_ts: datetime, carry: Sequence[str]) -> DataFrame:
    given = [c for c in ("record_id", "source_name") if c in rows.columns]
    shown = {c: f"coalesce(cast({c} as string), 'unknown')" if c in given else "'unknown'" for c in ("record_id", "source_name")}
    message = f"concat('No schema registered for source_type={source_type} version=', _version)"
    return rows.selectExpr(
        *[name(c) for c in carry if c not in shown],
        *[f"{e} as {c}" for c, e in shown.items()],
        f"{lit(source_type)} as source_type",
        "_version as schema_version",
        f"{lit(run_ts.isoformat())} as validated_at",
        f"array(named_struct('field_name', {lit(RECORD_ERROR_FIELD)}, 'message', {message},"
        f" 'error_code', {lit(RECORD_ERROR_CODE)}, 'input', cast(null as string))) as errors",
    )
