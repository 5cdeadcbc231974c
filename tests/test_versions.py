import pytest
from conftest import RUN_TS
from test_validate import DOCUMENT, changed

from siltgate.fixed_values import CSV, MONGO
from siltgate.operators.rulesets import CSV_USERS, DOCUMENT_USERS, PRODUCTS, STRICT_USERS, Registry, default_registry
from siltgate.operators.shapes import ENVELOPE, enveloped, outcomes
from siltgate.operators.validate import error_rows, validate
from siltgate.operators.versions import RULE_TABLE, register_rule_table, rule_named, validate_versions

USERS_AS_ROWS = [
    (MONGO, "rows", "field", i, field, rule, None)
    for i, (field, rule) in enumerate(
        [("user_id", "positive_int"), ("first_name", "stripped_text"), ("last_name", "stripped_text"), ("email", "email"),
         ("phone", "optional_phone"), ("gender", "non_blank"), ("date_of_birth", "iso_date"), ("city", "stripped_text"),
         ("country", "stripped_text"), ("address", "stripped_text"), ("is_active", "active_flag"),
         ("signup_source", "stripped_text"), ("membership", "stripped_text"), ("created_at", "iso_moment"), ("updated_at", "iso_moment")]
    )
] + [(MONGO, "rows", "cross", 99, None, "updated_after_created", None)]
BAD = [
    DOCUMENT, changed(DOCUMENT, user_id="x"), changed(DOCUMENT, email="none", city=" "), changed(DOCUMENT, updated_at="2020-01-01T00:00:00+00:00"),
    changed(DOCUMENT, created_at="2024-01-01T00:00:00"), {},
]


def table(spark, rows):
    return spark.createDataFrame(rows, RULE_TABLE)


def told(checked):
    return sorted((r["pos"], r["field_name"], r["error_code"], r["message"]) for r in error_rows(checked).collect())


def test_a_rule_table_gives_the_same_rules(spark, documents):
    registry = register_rule_table(Registry(), table(spark, USERS_AS_ROWS))
    assert registry.available_versions(MONGO) == ["rows"]
    frame = documents(*BAD)
    same = validate(frame, DOCUMENT_USERS, RUN_TS, "document", ["pos"]).checked
    mine = validate(frame, registry.resolve(MONGO, "rows"), RUN_TS, "document", ["pos"]).checked
    assert told(mine) == told(same) and len(told(mine)) > 5
    assert mine.select("record").collect() == same.select("record").collect()


def test_paths_objects_ids_and_parameters(spark, documents):
    rows = [
        ("api", "x", "field", 2, "sku", "absent_as_null:required_text", "meta.code"),
        ("api", "x", "field", 1, "tag", "text_of_length:3", None),
        ("api", "x", "object", 3, None, None, "meta"),
        ("api", "x", "id", 4, "tag", None, None),
    ]
    rule_set = register_rule_table(Registry(), table(spark, rows)).resolve("api", "x")
    assert rule_set.names == ["tag", "sku"] and rule_set.id_fields == ("tag",)
    checked = validate(documents({"tag": "abc", "meta": {"code": "s"}}, {"tag": "ab"}, {"meta": 5}), rule_set, RUN_TS, "document", ["pos"]).checked
    assert {(p, f) for p, f, _, _ in told(checked)} == {(1, "tag"), (1, "sku"), (2, "__batch__")}
    assert {r["record_id"] for r in checked.collect()} == {"abc", "ab", "unknown"}


@pytest.mark.parametrize("bad", [("field", "no_such"), ("cross", "no_such"), ("other", "status")])
def test_a_wrong_rule_table_is_refused(spark, bad):
    rows = [(CSV, "x", "field", 1, "a", "status", None), (CSV, "x", bad[0], 2, "b", bad[1], None)]
    with pytest.raises(ValueError):
        register_rule_table(Registry(), table(spark, rows))


def test_every_registered_rule_has_its_name():
    for rule_set in (CSV_USERS, PRODUCTS, DOCUMENT_USERS, STRICT_USERS):
        for field in rule_set.fields:
            if "." not in field.rule.__qualname__:  # made by another rule
                assert rule_named(field.rule.__name__) is field.rule


def test_rows_go_to_the_rules_of_their_version(spark, documents):
    registry = register_rule_table(default_registry(), table(spark, [(MONGO, "v2", "field", 1, "email", "email", None)]))
    frame = documents(*[changed(DOCUMENT, user_id=0, email="x")] * 4 + [DOCUMENT]).selectExpr(
        "pos", "document", "case pos when 0 then 'v1' when 1 then 'v2' when 2 then 'v7' when 4 then 'v2' end as schema_version"
    )
    found = validate_versions(frame, registry, MONGO, RUN_TS, document="document", carry=["pos"])
    assert [(p, f) for p, f, _, _ in told(found.checked)] == [
        (0, "email"), (0, "user_id"), (1, "email"), (2, "__batch__"), (3, "email"), (3, "user_id"),
    ]
    [unknown] = [m for p, _, _, m in told(found.checked) if p == 2]
    assert unknown == "No schema registered for source_type=mongo version=v7"
    assert found.by_version["v2"].accepted.select("record.email").first()["email"] == DOCUMENT["email"]
    assert found.by_version["v1"].checked.count() == 2 and found.unknown.first()["schema_version"] == "v7"
    with pytest.raises(ValueError):
        validate_versions(frame, registry, "ftp", RUN_TS, document="document")
    none = validate_versions(frame.limit(0), registry, MONGO, RUN_TS, document="document")
    assert none.checked.count() == 0


def test_outcomes_and_envelope(spark, documents):
    checked = validate(documents(DOCUMENT, changed(DOCUMENT, email="x")), DOCUMENT_USERS, RUN_TS, "document").checked
    rows = {r["valid"]: r for r in outcomes(checked).collect()}
    assert rows[True]["validated_record"]["normalized_record"]["email"] == DOCUMENT["email"] and rows[True]["errors"] == []
    assert rows[False]["validated_record"] is None and rows[False]["errors"][0]["context"] == {"input": "x"}
    frame = enveloped(spark.sql("select 1 as id, cast(null as string) as x, map('ID', '01') as came"), CSV, "id", RUN_TS, raw="came")
    assert frame.schema.simpleString() == spark.createDataFrame([], ENVELOPE).schema.simpleString()
    row = frame.first()
    assert row["record_id"] == "1" and row["raw_record"] == {"ID": "01"} and row["normalized_record"] == {"id": "1", "x": None}
