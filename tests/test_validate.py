import pytest
from conftest import RUN_TS

from siltgate.fixed_values import API, CSV, MONGO
from siltgate.operators import rules
from siltgate.operators.canonical import flatten, transform, union_sources
from siltgate.operators.rulesets import (
    CSV_USERS,
    DOCUMENT_USERS,
    PRODUCTS,
    STRICT_USERS,
    FieldRule,
    RuleSet,
    default_registry,
)
from siltgate.operators.validate import closed, validate

USER = {
    "user_id": "CSV1", "full_name": "Ann", "email": "a@b.c", "phone": "", "signup_date": "2024-01-05",
    "country": "X", "age": "33", "status": "active", "newsletter_opt_in": "",
}
DOCUMENT = {
    "user_id": 1, "first_name": "Alice", "last_name": "Smith", "email": "alice@example.com", "phone": "1234567890",
    "gender": "F", "date_of_birth": "1990-01-01", "city": "Seattle", "country": "USA", "address": "1 Main",
    "is_active": True, "signup_source": "web", "membership": "free",
    "created_at": "2024-01-01T00:00:00+00:00", "updated_at": "2024-01-01T00:00:00+00:00",
}
PRODUCT = {
    "id": 1, "title": "Thing", "category": "tools", "price": 9.5, "stock": 3, "tags": ["a", "b"],
    "dimensions": {"width": 1, "height": 2.5, "depth": "x"},
    "meta": {"barcode": "z", "createdAt": "2024-05-23T08:56:21.618Z"}, "availabilityStatus": "In Stock",
}
DROP = object()


def changed(base, **changes):
    return {k: x for k, x in {**base, **changes}.items() if x is not DROP}


def codes(row):
    return [(e["field_name"], e["error_code"]) for e in row["errors"]]


def check_users(spark, *changes):
    """Checked rows of the good user with each of the changes, in order."""
    rows = [(i, *{**USER, **c}.values()) for i, c in enumerate(changes)]
    frame = spark.createDataFrame(rows, "pos int, " + ", ".join(f"{k} string" for k in USER))
    return validate(frame, CSV_USERS, RUN_TS, carry=["pos"]).checked.orderBy("pos").collect()


def check_documents(documents, rule_set, base, *changes):
    frame = documents(*[changed(base, **c) for c in changes])
    return validate(frame, rule_set, RUN_TS, "document", carry=["pos"]).checked.orderBy("pos").collect()


def assert_codes(rows, cases):
    assert [(c, codes(r)) for r, (c, _) in zip(rows, cases)] == [(c, e) for c, e in cases]


CSV_USER_RULES = [
    ({}, []),
    ({"user_id": " "}, [("user_id", "string_too_short")]),
    ({"user_id": None}, []),
    ({"full_name": None}, [("full_name", "string_type")]),
    ({"full_name": " "}, []),
    ({"email": ""}, [("email", "value_error")]),
    ({"email": None}, [("email", "value_error")]),
    ({"email": "a@b"}, [("email", "value_error")]),
    ({"email": "@."}, []),
    ({"signup_date": "2024-1-5"}, [("signup_date", "value_error")]),
    ({"signup_date": None}, [("signup_date", "value_error")]),
    ({"country": ""}, [("country", "string_too_short")]),
    ({"status": " ACTIVE "}, []),
    ({"status": "gone"}, [("status", "value_error")]),
    ({"newsletter_opt_in": " y "}, []),
    ({"newsletter_opt_in": "maybe"}, [("newsletter_opt_in", "value_error")]),
    ({"age": "inf", "email": ""}, [("__batch__", "unexpected_exception")]),
    ({"email": "", "status": "x"}, [("email", "value_error"), ("status", "value_error")]),
]


def test_csv_user_rules(spark):
    cases = CSV_USER_RULES
    assert_codes(check_users(spark, *[c for c, _ in cases]), cases)


def test_csv_user_missing_columns(spark):
    frame = spark.createDataFrame([("CSV1",)], "user_id string")
    found = codes(validate(frame, CSV_USERS, RUN_TS).checked.first())
    assert found == [(f, "missing") for f in ("full_name", "email", "signup_date", "country", "status")]


def test_csv_user_values(spark):
    changes = {"status": " Active ", "newsletter_opt_in": "No", "age": "33.9", "phone": " 1 "}
    record = check_users(spark, changes)[0]["record"]
    assert (record["status"], record["newsletter_opt_in"], record["age"], record["phone"]) == ("active", False, 33, "1")


DOCUMENT_USER_RULES = [
    ({}, []),
    ({"user_id": "5.0"}, []),
    ({"user_id": " 7 "}, []),
    ({"user_id": True}, []),
    ({"user_id": 5.5}, [("user_id", "int_from_float")]),
    ({"user_id": "5.5"}, [("user_id", "int_parsing")]),
    ({"user_id": None}, [("user_id", "int_type")]),
    ({"user_id": DROP}, [("user_id", "missing")]),
    ({"user_id": 0}, [("user_id", "greater_than_equal")]),
    ({"user_id": [1]}, [("user_id", "int_type")]),
    ({"user_id": 10**19}, [("user_id", "int_parsing_size")]),
    ({"first_name": None}, [("first_name", "value_error")]),
    ({"first_name": 5}, []),
    ({"city": "  "}, [("city", "string_too_short")]),
    ({"email": "not-an-email"}, [("email", "value_error")]),
    ({"gender": " "}, [("gender", "value_error")]),
    ({"date_of_birth": {"$date": "1990-01-01T00:00:00Z"}}, []),
    ({"date_of_birth": "1990-13-01"}, [("date_of_birth", "value_error")]),
    ({"is_active": 2}, []),
    ({"is_active": "no"}, []),
    ({"is_active": "y"}, [("is_active", "value_error")]),
    ({"is_active": 1.0}, [("is_active", "value_error")]),
    ({"created_at": "soon"}, [("created_at", "value_error")]),
    ({"created_at": "2024-02-01T00:00:00Z"}, [("updated_at", "value_error")]),
    ({"created_at": "2023-01-01T00:00:00"}, [("__batch__", "unexpected_exception")]),
]


def test_document_user_rules(documents):
    cases = DOCUMENT_USER_RULES
    assert_codes(check_documents(documents, DOCUMENT_USERS, DOCUMENT, *[c for c, _ in cases]), cases)


def test_document_that_is_no_object(documents):
    row = validate(documents([1, 2]), DOCUMENT_USERS, RUN_TS, "document").checked.first()
    assert codes(row) == [("__batch__", "unexpected_exception")]
    assert row["errors"][0]["message"] == "'list' object has no attribute 'get'"


PRODUCT_RULES = [
    ({}, []),
    ({"id": DROP}, [("id", "int_type")]),
    ({"title": DROP}, [("title", "string_type")]),
    ({"title": ""}, [("title", "string_too_short")]),
    ({"price": -1.0}, [("price", "greater_than_equal")]),
    ({"price": "nan"}, [("price", "greater_than_equal")]),
    ({"price": "inf"}, []),
    ({"price": "x"}, [("price", "float_type")]),
    ({"stock": 5.7}, []),
    ({"stock": "5.7"}, [("stock", "int_type")]),
    ({"stock": "7"}, []),
    ({"stock": -1}, [("stock", "greater_than_equal")]),
    ({"brand": 5}, [("brand", "string_type")]),
    ({"dimensions": [1]}, [("__batch__", "unexpected_exception")]),
    ({"dimensions": []}, []),
    ({"meta": "x"}, [("__batch__", "unexpected_exception")]),
    ({"meta": None}, []),
]


def test_product_rules(documents):
    cases = PRODUCT_RULES
    assert_codes(check_documents(documents, PRODUCTS, PRODUCT, *[c for c, _ in cases]), cases)


def test_product_values(documents):
    record = check_documents(documents, PRODUCTS, PRODUCT, {"stock": 5.7, "tags": "one"})[0]["record"]
    assert (record["stock"], record["tags"]["items"], record["depth"], record["height"]) == (5, ["one"], None, 2.5)
    assert record["created_at"]["shown"] == "2024-05-23 08:56:21.618000+00:00"


STRICT_USER_RULES = [
    ({}, []),
    ({"first_name": 5}, [("first_name", "string_type")]),
    ({"phone": " 12345 "}, [("phone", "string_too_short")]),
    ({"email": "a@b"}, [("email", "value_error")]),
    ({"is_active": "on"}, []),
    ({"is_active": 2}, [("is_active", "bool_parsing")]),
    ({"is_active": 0.5}, [("is_active", "bool_type")]),
    ({"date_of_birth": "2024-01-01T10:00:00"}, [("date_of_birth", "date_from_datetime_inexact")]),
    ({"date_of_birth": "x"}, [("date_of_birth", "date_from_datetime_parsing")]),
    ({"created_at": None}, [("created_at", "datetime_type")]),
]


def test_strict_user_rules(documents):
    cases = STRICT_USER_RULES
    assert_codes(check_documents(documents, STRICT_USERS, DOCUMENT, *[c for c, _ in cases]), cases)


def test_batch_counts_errors_and_records(documents):
    found = validate(documents(DOCUMENT, changed(DOCUMENT, email="x", gender="")), DOCUMENT_USERS, RUN_TS, "document")
    row = found.summary.first()
    assert (row["processed"], row["accepted"], row["rejected"], row["rejected_records"]) == (2, 1, 2, 1)
    assert found.accepted.count() == 1
    details = found.rejected.orderBy("field_name").collect()
    assert [d["field_name"] for d in details] == ["email", "gender"]
    assert details[0]["context"] == {"input": "x"}


def test_empty_batch(documents, spark):
    frame = documents(DOCUMENT).limit(0)
    found = validate(frame, DOCUMENT_USERS, RUN_TS, "document")
    row = found.summary.first()
    assert (row["source_name"], row["processed"], row["errors"]) == ("unknown", 0, 0)
    assert transform(found.accepted, MONGO, RUN_TS).transformed.isEmpty()


def test_record_id_is_the_first_that_is_not_empty(spark):
    frame = spark.sql("select 'r1' as record_id, 'u' as user_id union all select '', 'u2' union all select null, ''")
    rows = validate(frame, RuleSet("csv", "v1", (FieldRule("user_id", rules.any_as_text),)), RUN_TS).checked
    assert sorted(r["record_id"] for r in rows.collect()) == ["r1", "u2", "unknown"]


def test_registry():
    registry = default_registry()
    assert registry.resolve(CSV) is CSV_USERS
    assert registry.available_versions(MONGO) == ["v1"]
    registry.register(MONGO, "strict", STRICT_USERS)
    assert registry.available_versions(MONGO) == ["v1", "strict"]
    with pytest.raises(ValueError):
        registry.resolve(CSV, "v9")
    with pytest.raises(ValueError):
        registry.resolve("ftp")


def test_closed_projection(spark):
    frame = spark.sql("select 'x' as email, 1 as other, 'y' as user_id")
    assert closed(frame, CSV_USERS).columns == ["user_id", "email"]


def test_canonical_document(documents):
    accepted = validate(documents(changed(DOCUMENT, phone=None)), DOCUMENT_USERS, RUN_TS, "document").accepted
    row = transform(accepted, MONGO, RUN_TS).transformed.first()
    canonical = row["canonical_record"]
    assert canonical["full_name"] == "Alice Smith" and canonical["phone"] is None
    assert canonical["created_at"] == "2024-01-01 00:00:00+00:00"
    assert len(canonical) == 19
    shown = transform(accepted, MONGO, RUN_TS, none_as_text=True).transformed.first()
    assert shown["canonical_record"]["phone"] == "None"


def test_canonical_products_and_rejects(documents):
    cases = documents(PRODUCT, changed(PRODUCT, id=2, tags=["a", 3], availabilityStatus="OUT OF STOCK"),
                      changed(PRODUCT, id=3, availabilityStatus="Out of stock"))
    found = transform(validate(cases, PRODUCTS, RUN_TS, "document").accepted, API, RUN_TS)
    rows = {r["canonical_record"]["product_id"]: r["canonical_record"] for r in found.transformed.collect()}
    assert rows[1]["tags"] == "a,b" and rows[1]["in_stock"] and not rows[3]["in_stock"]
    assert len(rows[1]) == 28
    assert found.rejected.first()["error"] == (
        "Unable to transform record 2: sequence item 1: expected str instance, int found"
    )
    summary = found.summary().first()
    assert (summary["processed"], summary["accepted"], summary["rejected"]) == (3, 2, 1)


def test_union_and_flatten(spark, documents):
    mongo = transform(validate(documents(DOCUMENT), DOCUMENT_USERS, RUN_TS, "document").accepted, MONGO, RUN_TS)
    api = transform(validate(documents(PRODUCT), PRODUCTS, RUN_TS, "document").accepted, API, RUN_TS)
    merged = union_sources({MONGO: mongo.transformed, API: api.transformed})
    assert merged.count() == 2
    flat = flatten(api.transformed, "other_id").first()
    assert flat["other_id"] == "1" and flat["product_id"] == 1
    plain = spark.sql("select 1 as id, 's' as source_name, 'r' as record_id, 'v1' as schema_version")
    assert flatten(plain, "id").columns == ["id"]
