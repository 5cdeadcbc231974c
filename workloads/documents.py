"""Document users: scans, selection, validation and mapping."""

from __future__ import annotations

from pyspark.sql import SparkSession

from siltgate.fixed_values import MONGO
from siltgate.functions import variants as v
from siltgate.operators import rules
from siltgate.operators.canonical import transform
from siltgate.operators.rulesets import DOCUMENT_USERS, STRICT_USERS, default_registry
from siltgate.operators.shapes import enveloped, outcomes
from siltgate.operators.validate import Validation, apply_rule, error_counts, validate
from siltgate.operators.versions import RULE_TABLE, register_rule_table, validate_versions
from siltgate.sources.documents import DocumentScan, documents_from, key_text, limited
from workloads.inputs import DOCUMENT_PARTS, DOCUMENTS, land, sql
from workloads.registry import RUN_TEXT, RUN_TS, query

COLLECTION = "users"


def scan(spark: SparkSession, sf_dir: str) -> DocumentScan:
    lines = land(spark, sf_dir, "documents", DOCUMENTS, "customer", "nation")
    return documents_from(lines, "line", COLLECTION, RUN_TS)


def checked_documents(spark: SparkSession, sf_dir: str, rule_set=DOCUMENT_USERS) -> Validation:
    return validate(scan(spark, sf_dir).documents, rule_set, RUN_TS, "document", carry=["pos"])


# Expected outcome per document, written against the JSON fragments.
_STRIPPED = "first_name last_name city country address signup_source membership".split()
_PLAIN = "regexp_replace({0}, '^\"|\"$', '', 'g')"


def _text(field: str) -> str:
    return _PLAIN.format(field)


_STRIPPED_ERRORS = "\n".join(
    f"""  union all select pos, rid, '{f}', case when {f} is null then 'missing' when {f} = 'null' then 'value_error'
    else 'string_too_short' end from outcome where not crash and ({f} is null or {f} = 'null' or trim({_text(f)}) = '')"""
    for f in _STRIPPED
)
EXPECTED = f"""
with parts as (select * from ({DOCUMENT_PARTS}) p where not (pos % 83 = 82 or pos % 97 = 96)),
facts as (
  select *, case when user_id = 'true' then 1 when user_id is null or user_id = 'null' then null
      else try_cast(regexp_replace({_text('user_id')}, '[.]0$', '') as bigint) end as maybe_id,
    user_id like '%.5' as fraction, {_text('email')} as mail, {_text('date_of_birth')} as dob_text,
    {_text('is_active')} as active_text, {_text('created_at')} as created_text, {_text('updated_at')} as updated_text
  from parts),
outcome as (
  select *, case when not fraction then maybe_id end as clean_id,
    case when email = 'null' then null else trim(mail) end as clean_mail,
    case when regexp_matches(dob_text, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') then try_cast(dob_text as date) end as dob,
    case when is_active in ('true', 'false') then is_active = 'true' when is_active in ('0', '7') then is_active = '7'
      when lower(active_text) = 'yes' then true end as active,
    created_text like '2024%' as created_ok, created_text like '%+00:00' as created_zoned,
    try_cast(replace(created_text, '+00:00', '') as timestamp) as created_utc,
    updated_text not like '%.250' as updated_zoned,
    case when updated_text like '%Z' then timestamp '2024-02-29 23:59:59' when updated_text like '%+02:00'
      then timestamp '2024-03-02 10:30:00.5' else timestamp '2024-03-02 10:00:00.25' end as updated_utc,
    created_text like '2024%' and (created_text like '%+00:00') != (updated_text not like '%.250') as crash,
    case when user_id is null or user_id in ('null', '0') then 'unknown' when user_id = 'true' then 'True'
      else {_text('user_id')} end as known_id
  from facts),
ids as (select *, case when crash then 'unknown' else known_id end as rid from outcome),
errors as (
  select pos, rid, '__batch__' as field_name, 'unexpected_exception' as error_code from ids where crash
  union all select pos, rid, 'user_id', case when user_id is null then 'missing' when user_id = 'null' then 'int_type'
    when fraction then 'int_from_float' when maybe_id is null then 'int_parsing' else 'greater_than_equal' end
    from ids where not crash and (clean_id is null or clean_id < 1)
{_STRIPPED_ERRORS.replace('from outcome', 'from ids')}
  union all select pos, rid, 'email', 'value_error' from ids
    where not crash and (email = 'null' or position('@' in mail) = 0 or position('.' in mail) = 0)
  union all select pos, rid, 'gender', 'value_error' from ids where not crash and (gender = 'null' or trim({_text('gender')}) = '')
  union all select pos, rid, 'date_of_birth', 'value_error' from ids where not crash and dob is null
  union all select pos, rid, 'is_active', 'value_error' from ids where not crash and active is null
  union all select pos, rid, 'created_at', 'value_error' from ids where not crash and not created_ok
  union all select pos, rid, 'updated_at', 'value_error' from ids
    where not crash and created_ok and updated_utc < created_utc),
good as (select * from ids where pos not in (select pos from errors))
"""
PHONE = "case when phone is null or phone = 'null' then null else nullif(trim(regexp_replace(phone, '\"', '', 'g')), '') end"


@query(
    "scan_documents",
    f"""select pos, 'users' as source_collection, '{RUN_TEXT}' as ingestion_timestamp,
      trim({_text('first_name')}) as first_name from ({DOCUMENT_PARTS}) p where not (pos % 83 = 82 or pos % 97 = 96)
      and first_name is distinct from 'null' and first_name is not null
      union all select pos, 'users', '{RUN_TEXT}', null from ({DOCUMENT_PARTS}) p
      where not (pos % 83 = 82 or pos % 97 = 96) and (first_name = 'null' or first_name is null)""",
)
def scan_documents(spark, sf_dir):
    return scan(spark, sf_dir).documents.selectExpr(
        "pos",
        "source_collection",
        "ingestion_timestamp",
        "trim(try_variant_get(document, '$.first_name', 'string')) as first_name",
    )


@query(
    "document_errors",
    """select c_custkey as pos, 'users' as source_collection, case when c_custkey % 83 = 82 then 'not valid JSON'
      else 'not a document' end as error, case when c_custkey % 83 = 82 then '{not json' else '[1, 2]' end as row
      from customer where c_custkey % 83 = 82 or c_custkey % 97 = 96""",
)
def document_errors(spark, sf_dir):
    return scan(spark, sf_dir).errors


@query(
    "find_documents",
    """select event_id from events where cast(json_extract(props, '$.k') as int) >= 20
      and cast(json_extract(props, '$.k') as int) != 30 and cast(json_extract(props, '$.k') as int) not in (41, 42)
      and (cast(json_extract(props, '$.k') as int) < 50 or cast(json_extract(props, '$.k') as int) = 77)""",
)
def find_documents(spark, sf_dir):
    lines = sql(spark, sf_dir, "select event_id, props from events", "events")
    found = documents_from(lines, "props", "events", RUN_TS).find(
        {
            "k": {"$gte": 20, "$ne": 30, "$nin": [41, 42], "$exists": True},
            "$or": [{"k": {"$lt": 50}}, {"k": 77}],
            "missing": None,
        }
    )
    return found.select("event_id")


@query(
    "limit_documents",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events order by event_id limit 500",
)
def limit_documents(spark, sf_dir):
    lines = sql(spark, sf_dir, "select event_id, props from events", "events")
    documents = documents_from(lines, "props", "events", RUN_TS).documents
    return limited(documents, 500, "event_id").selectExpr(
        "event_id", "try_variant_get(document, '$.k', 'bigint') as k"
    )


@query(
    "document_envelope",
    f"""select pos, 'users' as source_collection, lpad(cast(pos as varchar), 24, '0') as key,
      case when user_id = 'null' then 'None' when user_id = 'true' then 'True' else {_text('user_id')} end as user_key
      from ({DOCUMENT_PARTS}) p where not (pos % 83 = 82 or pos % 97 = 96)""",
)
def document_envelope(spark, sf_dir):
    user = v.field("document", "user_id")
    shown = f"case when {v.kind(user)} = '{v.NULL}' then 'None' else {v.python_text(user, v.kind(user), v.plain_text(user))} end"
    return scan(spark, sf_dir).documents.selectExpr(
        "pos", "source_collection", f"{key_text('document')} as key", f"{shown} as user_key"
    )


@query("doc_user_errors", EXPECTED + "select field_name, error_code, count(*) as n from errors group by all")
def doc_user_errors(spark, sf_dir):
    return error_counts(checked_documents(spark, sf_dir).checked)


@query(
    "validate_doc_users",
    EXPECTED
    + f"""select pos, rid as record_id, clean_id as user_id, trim({_text('first_name')}) as first_name,
      {_text('last_name')} as last_name, clean_mail as email, {PHONE} as phone, cast(dob as varchar) as date_of_birth,
      {_text('city')} as city, {_text('country')} as country, active as is_active,
      epoch_us(created_utc) as created_us, epoch_us(updated_utc) as updated_us, updated_zoned from good""",
)
def validate_doc_users(spark, sf_dir):
    return checked_documents(spark, sf_dir).accepted.selectExpr(
        "pos",
        "record_id",
        "record.user_id",
        "record.first_name",
        "record.last_name",
        "record.email",
        "record.phone",
        "cast(record.date_of_birth as string) as date_of_birth",
        "record.city",
        "record.country",
        "record.is_active",
        "unix_micros(record.created_at.at) as created_us",
        "unix_micros(record.updated_at.at) as updated_us",
        "record.updated_at.zoned as updated_zoned",
    )


@query(
    "canonical_doc_users",
    EXPECTED
    + f"""select clean_id as user_id, trim({_text('first_name')}) as first_name, {_text('last_name')} as last_name,
      concat(trim({_text('first_name')}), ' ', {_text('last_name')}) as full_name, clean_mail as email, {PHONE} as phone,
      'F' as gender, cast(dob as varchar) as date_of_birth, {_text('city')} as city, {_text('country')} as country,
      {_text('address')} as address, active as is_active, 'web' as signup_source, 'free' as membership,
      replace(created_text, 'T', ' ') as created_at,
      replace(replace(replace(replace(updated_text, 'T', ' '), 'Z', '+00:00'), '.250', '.250000'), '.500', '.500000') as updated_at,
      'unknown' as source, 'mongo' as source_type, '{RUN_TEXT}' as validated_at from good""",
)
def canonical_doc_users(spark, sf_dir):
    accepted = checked_documents(spark, sf_dir).accepted
    return transform(accepted, MONGO, RUN_TS).transformed.select("canonical_record.*")


@query(
    "check_cross_field",
    EXPECTED + "select pos, error_code from errors where field_name in ('updated_at', '__batch__')",
)
def check_cross_field(spark, sf_dir):
    rejected = checked_documents(spark, sf_dir).rejected
    return rejected.filter("field_name in ('updated_at', '__batch__')").select("pos", "error_code")


@query(
    "require_non_blank",
    f"""select pos, case when gender = 'null' then 'value_error' when trim({_text('gender')}) = '' then 'value_error' end as gender_code,
      case when first_name is null then 'missing' when first_name = 'null' then 'value_error'
        when trim({_text('first_name')}) = '' then 'string_too_short' end as name_code
      from ({DOCUMENT_PARTS}) p where not (pos % 83 = 82 or pos % 97 = 96)""",
)
def require_non_blank(spark, sf_dir):
    documents = scan(spark, sf_dir).documents.select("pos", "document")
    gender = apply_rule(documents, "gender", rules.non_blank, "document")
    gender = gender.selectExpr("pos", "document", "error_code as gender_code")
    name = apply_rule(gender, "first_name", rules.stripped_text, "document")
    return name.selectExpr("pos", "gender_code", "error_code as name_code")


_STRICT_TEXT = "\n".join(
    f"""  union all select pos, '{f}', case when {f} is null then 'missing' when {f} not like '"%' then 'string_type'
    else 'string_too_short' end from strict where not crash and ({f} is null or {f} not like '"%' or trim({_text(f)}) = '')"""
    for f in ["gender", *_STRIPPED]
)


@query(
    "validate_strict_users",
    EXPECTED.rstrip()
    + f""",
strict as (select *, trim(regexp_replace(phone, '"', '', 'g')) as phone_text from ids),
problems as (
  select pos, '__batch__' as field_name, 'unexpected_exception' as error_code from strict where crash
  union all select pos, field_name, error_code from errors where field_name in ('user_id', 'updated_at')
{_STRICT_TEXT}
  union all select pos, 'email', case when email = 'null' then 'string_type' else 'value_error' end
    from strict where not crash and (email = 'null' or position('@' in mail) = 0 or position('.' in mail) = 0)
  union all select pos, 'phone', case when phone is null then 'missing' when phone = 'null' then 'string_type'
    else 'string_too_short' end from strict where not crash and (phone is null or phone = 'null' or length(phone_text) < 7)
  union all select pos, 'date_of_birth', 'date_from_datetime_parsing' from strict where not crash and dob is null
  union all select pos, 'is_active', 'bool_parsing' from strict where not crash and is_active = '7'
  union all select pos, 'created_at', 'datetime_from_date_parsing' from strict where not crash and not created_ok)
select field_name, error_code, count(*) as n from problems group by all""",
)
def validate_strict_users(spark, sf_dir):
    return error_counts(checked_documents(spark, sf_dir, STRICT_USERS).checked)


# --- versions in one batch -------------------------------------------------------------

VERSION = "case pos % 5 when 0 then 'v2' when 1 then 'v9' when 2 then cast(null as string) else 'v1' end"
SECOND_VERSION = [
    (MONGO, "v2", "field", 1, "user_id", "positive_int", None),
    (MONGO, "v2", "field", 2, "email", "email", None),
    (MONGO, "v2", "field", 3, "sex", "non_blank", "gender"),
]


@query(
    "validate_by_version",
    EXPECTED
    + """, versions as (select pos, case pos % 5 when 0 then 'v2' when 1 then 'v9' else 'v1' end as version from parts),
    second as (
      select pos, 'user_id' as field_name from ids where clean_id is null or clean_id < 1
      union all select pos, 'email' from ids where email = 'null' or position('@' in mail) = 0 or position('.' in mail) = 0
      union all select pos, 'sex' from ids where gender = 'null' or trim(regexp_replace(gender, '"', '', 'g')) = ''),
    found as (
      select pos, field_name from errors where pos in (select pos from versions where version = 'v1')
      union all select pos, field_name from second where pos in (select pos from versions where version = 'v2')
      union all select pos, 'No schema registered for source_type=mongo version=v9' from versions where version = 'v9')
    select v.pos, v.version as schema_version, count(f.field_name) as n_errors,
      coalesce(string_agg(f.field_name, ',' order by f.field_name), '') as fields
    from versions v left join found f on v.pos = f.pos group by v.pos, v.version""",
)
def validate_by_version(spark, sf_dir):
    """Rows of two registered versions, of none named, and of one that nobody registered."""
    registry = register_rule_table(default_registry(), spark.createDataFrame(SECOND_VERSION, RULE_TABLE))
    rows = scan(spark, sf_dir).documents.selectExpr("pos", "document", f"{VERSION} as schema_version")
    checked = validate_versions(rows, registry, MONGO, RUN_TS, document="document", carry=["pos"]).checked
    told = "transform(errors, e -> case when e.message like 'No schema%' then e.message else e.field_name end)"
    return checked.selectExpr(
        "pos", "schema_version", "cast(size(errors) as bigint) as n_errors", f"array_join(array_sort({told}), ',') as fields"
    )


@query(
    "validation_outcomes",
    EXPECTED
    + """select i.rid as record_id, 'mongo' as source_type, count(e.field_name) = 0 as valid, count(e.field_name) as n_errors,
      case when count(e.field_name) = 0 then any_value(i.clean_id) end as user_id,
      coalesce(string_agg(e.error_code, ',' order by e.error_code), '') as codes from ids i left join errors e on e.pos = i.pos
      group by i.pos, i.rid""",
)
def validation_outcomes(spark, sf_dir):
    return outcomes(checked_documents(spark, sf_dir).checked).selectExpr(
        "record_id", "source_type", "valid", "cast(size(errors) as bigint) as n_errors",
        "validated_record.normalized_record.user_id as user_id",
        "array_join(array_sort(transform(errors, e -> e.error_code)), ',') as codes",
    )


@query(
    "base_envelope",
    f"""select 'unknown' as source_name, 'csv' as source_type, cast(s_suppkey as varchar) as record_id,
      epoch_us(timestamp '{RUN_TS:%Y-%m-%d %H:%M:%S}') as ingested_us, s_name as name, cast(s_nationkey as varchar) as nation,
      2 as n_fields from supplier""",
)
def base_envelope(spark, sf_dir):
    rows = sql(spark, sf_dir, "select s_suppkey as id, s_name as name, s_nationkey as nation from supplier", "supplier")
    return enveloped(rows, "csv", "id", RUN_TS).selectExpr(
        "source_name", "source_type", "record_id", "unix_micros(ingestion_timestamp) as ingested_us",
        "raw_record['name'] as name", "normalized_record['nation'] as nation", "size(normalized_record) - 1 as n_fields",
    )
