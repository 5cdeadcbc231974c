"""CSV users: validation, coercions, summaries and mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltgate.fixed_values import CSV
from siltgate.functions import moments
from siltgate.functions import text as t
from siltgate.operators import rules
from siltgate.operators.canonical import transform
from siltgate.operators.rulesets import CSV_USERS
from siltgate.operators.validate import Validation, apply_rule, closed, error_counts, validate
from workloads.inputs import USERS, land, sql
from workloads.registry import RUN_TEXT, RUN_TS, query


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land(spark, sf_dir, "users", USERS, "customer", "nation")


def checked_users(spark: SparkSession, sf_dir: str) -> Validation:
    return validate(users(spark, sf_dir), CSV_USERS, RUN_TS, carry=["pos"])


# Expected outcome per row, written against the raw text.
EXPECTED = f"""
with raw as ({USERS}),
facts as (
  select *, lower(trim(age)) as age_text, trim(email) as mail, lower(trim(status)) as state,
    lower(trim(newsletter_opt_in)) as opt,
    case when regexp_matches(signup_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') then try_cast(signup_date as date) end as day
  from raw),
problems as (
  select *, age_text = 'inf' as crash,
    trim(user_id) = '' as bad_id, full_name = '' as bad_name, country = '' as bad_country,
    mail = '' or position('@' in mail) = 0
      or position('.' in list_extract(string_split(mail, '@'), -1)) = 0 as bad_email,
    day is null as bad_day,
    state not in ('active', 'inactive', 'suspended', 'pending') as bad_status,
    opt not in ('', 'yes', 'y', 'true', '1', 'no', 'n', 'false', '0') as bad_opt,
    trunc(try_cast(case when age_text in ('nan', 'inf') then null else age_text end as double)) as years
  from facts),
outcome as (
  select *, case when crash then 1 else bad_id::int + bad_name::int + bad_email::int + bad_day::int
    + bad_country::int + bad_status::int + bad_opt::int end as n_errors,
    case when years between 1 and 150 then years::int end as clean_age,
    case when opt in ('yes', 'y', 'true', '1') then true when opt in ('no', 'n', 'false', '0') then false end as clean_opt,
    nullif(trim(phone), '') as clean_phone,
    case when crash then 'unknown' when user_id = '' then 'unknown' else user_id end as rid
  from problems),
errors as (
  select pos, rid, '__batch__' as field_name, 'unexpected_exception' as error_code,
    'cannot convert float infinity to integer' as message from outcome where crash
  union all select pos, rid, 'user_id', 'string_too_short', 'String should have at least 1 character'
    from outcome where not crash and bad_id
  union all select pos, rid, 'full_name', 'string_too_short', 'String should have at least 1 character'
    from outcome where not crash and bad_name
  union all select pos, rid, 'email', 'value_error', case when mail = '' then 'Value error, email must not be blank'
      else concat('Value error, email is malformed (missing @ or domain): ''', mail, '''') end
    from outcome where not crash and bad_email
  union all select pos, rid, 'signup_date', 'value_error',
      concat('Value error, signup_date must be YYYY-MM-DD, got: ''', signup_date, '''')
    from outcome where not crash and bad_day
  union all select pos, rid, 'status', 'value_error',
      concat('Value error, status must be one of {{''active'', ''inactive'', ''suspended'', ''pending''}}, got: ''', state, '''')
    from outcome where not crash and bad_status
  union all select pos, rid, 'newsletter_opt_in', 'value_error',
      concat('Value error, newsletter_opt_in must be yes/no/true/false/y/n/1/0, got: ''', newsletter_opt_in, '''')
    from outcome where not crash and bad_opt)
"""
ACCEPTED_COLUMNS = """trim(user_id) as user_id, full_name, mail as email, clean_phone as phone,
  cast(day as varchar) as signup_date, country, clean_age as age, state as status, clean_opt as newsletter_opt_in"""


@query(
    "validate_csv_users",
    EXPECTED + f"select pos, {ACCEPTED_COLUMNS} from outcome where n_errors = 0",
)
def validate_csv_users(spark, sf_dir):
    return checked_users(spark, sf_dir).accepted.selectExpr(
        "pos",
        "record.user_id",
        "record.full_name",
        "record.email",
        "record.phone",
        "cast(record.signup_date as string) as signup_date",
        "record.country",
        "record.age",
        "record.status",
        "record.newsletter_opt_in",
    )


@query(
    "csv_user_errors",
    EXPECTED + "select field_name, error_code, count(*) as n from errors group by all",
)
def csv_user_errors(spark, sf_dir):
    return error_counts(checked_users(spark, sf_dir).checked)


@query(
    "accepted_users",
    EXPECTED
    + f"""select rid as record_id, 'unknown' as source_name, 'csv' as source_type, 'v1' as schema_version,
      '{RUN_TEXT}' as validated_at from outcome where n_errors = 0""",
)
def accepted_users(spark, sf_dir):
    return checked_users(spark, sf_dir).accepted.drop("record", "pos")


@query(
    "rejected_users",
    EXPECTED
    + """select pos, rid as record_id, 'unknown' as source_name, 'csv' as source_type, field_name, message, error_code
      from errors""",
)
def rejected_users(spark, sf_dir):
    return checked_users(spark, sf_dir).rejected.select(
        "pos", "record_id", "source_name", "source_type", "field_name", "message", "error_code"
    )


@query(
    "unexpected_errors",
    EXPECTED + "select pos, rid as record_id, message from errors where field_name = '__batch__'",
)
def unexpected_errors(spark, sf_dir):
    rejected = checked_users(spark, sf_dir).rejected
    return rejected.filter("error_code = 'unexpected_exception'").select("pos", "record_id", "message")


@query(
    "validation_summary",
    EXPECTED
    + f"""select 'unknown' as source_name, 'csv' as source_type, 'v1' as schema_version, count(*) as processed,
      count(*) filter (n_errors = 0) as accepted, sum(n_errors)::bigint as rejected, 0::bigint as skipped,
      sum(n_errors)::bigint as errors, count(*) filter (n_errors > 0) as rejected_records,
      '{RUN_TEXT}' as validated_at from outcome""",
)
def validation_summary(spark, sf_dir):
    return checked_users(spark, sf_dir).summary


@query(
    "canonical_csv_users",
    EXPECTED
    + f"""select trim(user_id) as user_id, trim(full_name) as full_name, mail as email, clean_phone as phone,
      cast(day as varchar) as signup_date, country, clean_age as age, state as status, state = 'active' as is_active,
      clean_opt as newsletter_opt_in, 'unknown' as source, 'csv' as source_type, '{RUN_TEXT}' as validated_at
      from outcome where n_errors = 0""",
)
def canonical_csv_users(spark, sf_dir):
    accepted = checked_users(spark, sf_dir).accepted
    return transform(accepted, CSV, RUN_TS).transformed.select("canonical_record.*")


@query(
    "closed_projection",
    f"select user_id, full_name, email, phone, signup_date, country, age, status, newsletter_opt_in from ({USERS}) raw",
)
def closed_projection(spark, sf_dir):
    return closed(users(spark, sf_dir), CSV_USERS)


@query(
    "record_id",
    EXPECTED
    + """select pos, coalesce(case when pos % 5 = 0 then null when pos % 5 = 1 then '' else concat('r', pos) end,
      'never') as given, case when pos % 5 > 1 then concat('r', pos) else rid end as record_id from outcome""",
)
def record_id(spark, sf_dir):
    given = "case when pos % 5 = 0 then null when pos % 5 = 1 then '' else concat('r', pos) end"
    frame = users(spark, sf_dir).selectExpr("*", f"{given} as record_id")
    found = validate(frame, CSV_USERS, RUN_TS, carry=["pos"]).checked
    return found.selectExpr(
        "pos",
        "case when pos % 5 = 0 then 'never' when pos % 5 = 1 then '' else concat('r', pos) end as given",
        "record_id",
    )


# --- single rules -----------------------------------------------------------------


@query(
    "coerce_age",
    EXPECTED + "select pos, age, clean_age as years, crash from outcome",
)
def coerce_age(spark, sf_dir):
    found = apply_rule(users(spark, sf_dir), "age", rules.age)
    return found.selectExpr("pos", "age", "value as years", "crash is not null as crash")


@query(
    "coerce_bool",
    EXPECTED + "select pos, clean_opt as value, bad_opt as bad from outcome",
)
def coerce_bool(spark, sf_dir):
    found = apply_rule(users(spark, sf_dir), "newsletter_opt_in", rules.opt_in)
    return found.selectExpr("pos", "value", "error_code is not null as bad")


@query(
    "check_email",
    """select doc_id, position('@' in text) > 0 and position('.' in list_extract(string_split(text, '@'), -1)) > 0
      as ok from documents""",
)
def check_email(spark, sf_dir):
    texts = sql(spark, sf_dir, "select doc_id, text from documents", "documents")
    return texts.selectExpr("doc_id", f"not {t.malformed_email('text')} as ok")


@query(
    "check_date",
    EXPECTED + "select pos, signup_date, cast(day as varchar) as day from outcome",
)
def check_date(spark, sf_dir):
    return users(spark, sf_dir).selectExpr(
        "pos", "signup_date", f"cast({moments.iso_date('signup_date')} as string) as day"
    )


@query(
    "check_enum",
    EXPECTED + "select state as status, not bad_status as ok, count(*) as n from outcome group by all",
)
def check_enum(spark, sf_dir):
    found = apply_rule(users(spark, sf_dir).select("status"), "status", rules.status)
    found = found.selectExpr("value as status", "error_code is null as ok")
    return found.groupBy("status", "ok").count().withColumnRenamed("count", "n")


@query(
    "trim_all",
    """with t as (select conv_id, turn, concat(chr(9), ' ', text, chr(160), chr(12288), chr(10)) as padded from conversations)
      select conv_id, turn, md5(trim(padded, concat(chr(9), chr(10), chr(11), chr(12), chr(13), ' ', chr(133), chr(160),
      chr(5760), chr(8232), chr(8233), chr(12288)))) as digest from t""",
)
def trim_all(spark, sf_dir):
    padded = "concat('\\t ', text, '\\u00a0\\u3000\\n')"
    frame = sql(spark, sf_dir, "select * from conversations", "conversations")
    return frame.selectExpr("conv_id", "turn", f"md5({t.strip(padded)}) as digest")
