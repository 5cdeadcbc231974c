"""Versioned rule sets and their registry. A rule set is data: fields and rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from siltgate.fixed_values import API, CSV, DEFAULT_VERSION, EMAIL_HINT, MONGO, SOURCE_TYPES, VALUE_ERRORS
from siltgate.functions import variants
from siltgate.operators import rules
from siltgate.operators.rules import Cell, Outcome, Rule


@dataclass(frozen=True)
class FieldRule:
    """``path`` is where a document keeps the field, when not under its own name."""

    name: str
    rule: Rule
    path: tuple[str, ...] = ()

    @property
    def keys(self) -> tuple[str, ...]:
        return self.path or (self.name,)


# Sees the cells by field name; names the field a problem belongs to.
CrossRule = Callable[[dict[str, Cell]], tuple[str, Outcome]]


@dataclass(frozen=True)
class RuleSet:
    source_type: str
    version: str
    fields: tuple[FieldRule, ...]
    cross: tuple[CrossRule, ...] = ()
    # Paths that must hold an object, or nothing, for the record to be readable.
    object_paths: tuple[tuple[str, ...], ...] = ()
    # The fields a record id is taken from: the first non-empty one.
    id_fields: tuple[str, ...] = ("user_id", "id")
    # Products are known by their id alone, shown as checked or as it came.
    id_from_value: bool = False

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _named(rule: Rule, *names: str) -> list[FieldRule]:
    return [FieldRule(name, rule) for name in names]


def updated_after_created(cells: dict[str, Cell]) -> tuple[str, Outcome]:
    """updated_at may not be before created_at; judged only when both were read."""
    created, updated = cells["created_at"], cells["updated_at"]
    early = f"{updated.part('at')} < {created.part('at')}"
    mixed = f"({created.part('offset')} = '') != ({updated.part('offset')} = '')"
    both = f"{created.part('at')} is not null and {updated.part('at')} is not null"
    reason = "\"can't compare offset-naive and offset-aware datetimes\""
    return "updated_at", Outcome(
        updated.text,
        [(early, rules.value_error(VALUE_ERRORS["order"]))],
        f"case when {both} and {mixed} then {reason} end",
    )


CSV_USERS = RuleSet(
    CSV,
    DEFAULT_VERSION,
    (
        FieldRule("user_id", rules.any_as_text),
        FieldRule("full_name", rules.required_text),
        FieldRule("email", rules.email(EMAIL_HINT)),
        FieldRule("phone", rules.optional_phone),
        FieldRule("signup_date", rules.iso_date),
        FieldRule("country", rules.required_text),
        FieldRule("age", rules.age),
        FieldRule("status", rules.status),
        FieldRule("newsletter_opt_in", rules.opt_in),
    ),
)

PRODUCTS = RuleSet(
    API,
    DEFAULT_VERSION,
    (
        FieldRule("id", rules.absent_as_null(rules.positive_int)),
        FieldRule("title", rules.absent_as_null(rules.required_text)),
        FieldRule("description", rules.optional_text),
        FieldRule("category", rules.absent_as_null(rules.required_text)),
        FieldRule("price", rules.required_float),
        FieldRule("discount_percentage", rules.lenient_float, ("discountPercentage",)),
        FieldRule("rating", rules.lenient_float),
        FieldRule("stock", rules.required_count),
        FieldRule("tags", rules.tag_list),
        FieldRule("brand", rules.optional_text),
        FieldRule("sku", rules.optional_text),
        FieldRule("weight", rules.lenient_float),
        FieldRule("width", rules.lenient_float, ("dimensions", "width")),
        FieldRule("height", rules.lenient_float, ("dimensions", "height")),
        FieldRule("depth", rules.lenient_float, ("dimensions", "depth")),
        FieldRule("warranty_information", rules.optional_text, ("warrantyInformation",)),
        FieldRule("shipping_information", rules.optional_text, ("shippingInformation",)),
        FieldRule("availability_status", rules.optional_text, ("availabilityStatus",)),
        FieldRule("return_policy", rules.optional_text, ("returnPolicy",)),
        FieldRule("minimum_order_quantity", rules.lenient_int, ("minimumOrderQuantity",)),
        FieldRule("barcode", rules.optional_text, ("meta", "barcode")),
        FieldRule("created_at", rules.optional_moment, ("meta", "createdAt")),
        FieldRule("updated_at", rules.optional_moment, ("meta", "updatedAt")),
        FieldRule("thumbnail", rules.optional_text),
    ),
    object_paths=(("dimensions",), ("meta",)),
    id_fields=("id",),
    id_from_value=True,
)

DOCUMENT_USERS = RuleSet(
    MONGO,
    DEFAULT_VERSION,
    (
        FieldRule("user_id", rules.positive_int),
        *_named(rules.stripped_text, "first_name", "last_name"),
        FieldRule("email", rules.email()),
        FieldRule("phone", rules.optional_phone),
        FieldRule("gender", rules.non_blank),
        FieldRule("date_of_birth", rules.iso_date),
        *_named(rules.stripped_text, "city", "country", "address"),
        FieldRule("is_active", rules.active_flag),
        *_named(rules.stripped_text, "signup_source", "membership"),
        *_named(rules.iso_moment, "created_at", "updated_at"),
    ),
    cross=(updated_after_created,),
)

STRICT_USERS = RuleSet(
    MONGO,
    "strict",
    (
        FieldRule("user_id", rules.positive_int),
        *_named(rules.text_of_length(1), "first_name", "last_name"),
        FieldRule("email", rules.strict_email),
        FieldRule("phone", rules.text_of_length(7)),
        FieldRule("gender", rules.text_of_length(1)),
        FieldRule("date_of_birth", rules.strict_date),
        *_named(rules.text_of_length(1), "city", "country", "address"),
        FieldRule("is_active", rules.strict_bool),
        *_named(rules.text_of_length(1), "signup_source", "membership"),
        *_named(rules.strict_moment, "created_at", "updated_at"),
    ),
    cross=(updated_after_created,),
)


@dataclass
class Registry:
    """Rule sets by (source type, version)."""

    _sets: dict[tuple[str, str], RuleSet] = field(default_factory=dict)

    def register(self, source_type: str, version: str, rule_set: RuleSet) -> None:
        self._sets[(source_type, version)] = rule_set

    def resolve(self, source_type: str, version: str = DEFAULT_VERSION) -> RuleSet:
        if source_type not in SOURCE_TYPES and not self.available_versions(source_type):
            raise ValueError(f"unknown source type: {source_type}")
        if (source_type, version) not in self._sets:
            raise ValueError(f"no rule set for source type {source_type}, version {version}")
        return self._sets[(source_type, version)]

    def available_versions(self, source_type: str) -> list[str]:
        return [version for known, version in self._sets if known == source_type]


def default_registry() -> Registry:
    """CSV users, products and document users, each as v1."""
    registry = Registry()
    for rule_set in (CSV_USERS, PRODUCTS, DOCUMENT_USERS):
        registry.register(rule_set.source_type, rule_set.version, rule_set)
    return registry


def flatten_columns(document: str, rule_set: RuleSet = PRODUCTS) -> list[str]:
    """A nested document as flat VARIANT columns under the rule set's field names."""
    return [f"{variants.field(document, *f.keys)} as {f.name}" for f in rule_set.fields]
