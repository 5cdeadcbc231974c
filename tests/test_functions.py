from datetime import date

import pytest
from pyspark.sql import functions as F

from siltgate.functions import moments, numbers, redact, text


def evaluate(spark, expression, values, sql_type="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, x {sql_type}").selectExpr("i", f"{expression} as y")
    return [r["y"] for r in frame.orderBy("i").collect()]


def test_strip_takes_every_unicode_blank(spark):
    values = ["\t a \n", " b　", "\x1cc\x85", "d e", "  ", None]
    assert evaluate(spark, text.strip("x"), values) == ["a", "b", "c", "d e", "", None]


def test_blank_to_null(spark):
    assert evaluate(spark, text.blank_to_null("x"), [" a ", " \t", "", None]) == ["a", None, None, None]


def test_literal_escapes_quotes_and_backslashes(spark):
    for value in ("it's", "a\\b", "\\'", "plain"):
        assert spark.sql(f"select {text.lit(value)} as v").first()["v"] == value


def test_malformed_email_looks_after_the_last_at(spark):
    values = ["a@b.c", "a@b@c.com", "@.", "no-at", "a.b@c", "a@b.c@d"]
    assert evaluate(spark, text.malformed_email("x"), values) == [False, False, False, True, True, True]


def test_int_from_text(spark):
    values = ["5", " 5 ", "+3", "-4", "1_000", "1__0", "5.0", "abc", "", "99999999999999999999"]
    assert evaluate(spark, numbers.int_from_text("x"), values) == [
        5, 5, 3, -4, 1000, None, None, None, None, None,
    ]
    wide = evaluate(spark, numbers.int_from_text("x", "decimal(38,0)"), ["99999999999999999999"])
    assert int(wide[0]) == 99999999999999999999


def test_lax_int_takes_a_fraction_of_zeros(spark):
    values = ["5.0", "5.00", "5.", ".0", "5.5", "1e3"]
    assert evaluate(spark, numbers.lax_int_from_text("x"), values) == [5, 5, None, None, None, None]


def test_float_from_text(spark):
    values = ["1.5", " 2 ", "1_0.5", "1e2", ".5", "5.", "1d", "1f", "0x1", "-inf", "Infinity", "abc"]
    inf = float("inf")
    assert evaluate(spark, numbers.float_from_text("x"), values) == [
        1.5, 2.0, 10.5, 100.0, 0.5, 5.0, None, None, None, -inf, inf, None,
    ]
    nan = evaluate(spark, numbers.float_from_text("x"), ["nan"])[0]
    assert nan != nan


def test_age(spark):
    cases = {
        "33.9": 33, "0.5": None, "-1": None, "200": None, "150": 150, "150.9": 150, "151": None,
        "banana": None, "": None, " 40 ": 40, "nan": None, None: None,
    }
    assert evaluate(spark, numbers.age_from_text("x"), list(cases)) == list(cases.values())


def test_iso_date_is_strict(spark):
    values = ["2024-01-05", " 2024-01-05 ", "2024-02-30", "2024-1-5", "2024", "20240105", "2024-01-05T10:00", "0000-01-01"]
    day = date(2024, 1, 5)
    assert evaluate(spark, moments.iso_date("x"), values) == [day, day, None, None, None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_moment_does_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        values = [
            "2024-01-05", "2024-01-05T10", "2024-01-05 10:11", "2024-01-05T10:11:12", "2024-01-05T10:11:12.123",
            "2024-01-05T10:11:12.123456Z", "2024-01-05T10:11:12+02:00", "2024-01-05T10+02:00",
            "2024-01-05T10:11:12.12", "2024-01-05T25:00", "yesterday", None,
        ]
        micros = evaluate(spark, f"unix_micros({moments.iso_moment('x')})", values)
        midnight = 1704412800 * 1_000_000
        hour, minute, second = 3600 * 1_000_000, 60 * 1_000_000, 1_000_000
        full = midnight + 10 * hour + 11 * minute + 12 * second
        assert micros == [
            midnight, midnight + 10 * hour, midnight + 10 * hour + 11 * minute, full, full + 123_000,
            full + 123_456, full - 2 * hour, midnight + 8 * hour, None, None, None, None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_redact_columns_by_name(spark):
    frame = spark.sql("select 'a' as password, 'b' as `api-key`, 'c' as Author, 'd' as name")
    assert redact.redact_columns(frame).first().asDict() == {
        "password": "[REDACTED]", "api-key": "[REDACTED]", "Author": "[REDACTED]", "name": "d",
    }


def test_redact_map_by_key(spark):
    frame = spark.sql("select map('API_KEY', 'x', 'Secret', 'y', 'user', 'z') as m")
    shown = frame.select(F.expr(redact.redact_map("m")).alias("m")).first()["m"]
    assert shown == {"API_KEY": "[REDACTED]", "Secret": "[REDACTED]", "user": "z"}
