"""Products: flattening, validation, coercions and mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltgate.fixed_values import API
from siltgate.operators import rules
from siltgate.operators.canonical import transform
from siltgate.operators.rulesets import PRODUCTS as PRODUCT_RULES
from siltgate.operators.rulesets import flatten_columns
from siltgate.operators.validate import Validation, apply_rule, error_counts, validate
from siltgate.sources.documents import documents_from
from workloads.inputs import PRODUCT_PARTS, PRODUCTS, land, sql
from workloads.registry import RUN_TEXT, RUN_TS, query


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = land(spark, sf_dir, "products", PRODUCTS, "part")
    documents = documents_from(lines, "line", "products", RUN_TS).documents
    return documents.selectExpr("pos", "'api_source' as source_name", "document")


def checked_products(spark: SparkSession, sf_dir: str) -> Validation:
    return validate(products(spark, sf_dir), PRODUCT_RULES, RUN_TS, "document", carry=["pos"])


EXPECTED = f"""
with parts as (select * from ({PRODUCT_PARTS}) p),
facts as (
  select *, try_cast(id as bigint) as clean_id, trim(regexp_replace(title, '"', '', 'g')) as title_text,
    try_cast(regexp_replace(price, '"', '', 'g') as double) as clean_price,
    case stock when '5.7' then 5 when '"5.7"' then null when '"7"' then 7 else try_cast(stock as bigint) end as clean_stock,
    coalesce(dimensions = '[1]', false) or meta = '"none"' as crash
  from parts),
errors as (
  select pos, '__batch__' as field_name, 'unexpected_exception' as error_code from facts where crash
  union all select pos, 'id', case when id is null then 'int_type' when clean_id is null then 'int_parsing'
    else 'greater_than_equal' end from facts where not crash and (clean_id is null or clean_id < 1)
  union all select pos, 'title', case when title is null then 'string_type' else 'string_too_short' end
    from facts where not crash and (title is null or title = '""')
  union all select pos, 'category', 'string_type' from facts where not crash and category = '5'
  union all select pos, 'price', case when clean_price is null then 'float_type' else 'greater_than_equal' end
    from facts where not crash and (clean_price is null or clean_price < 0)
  union all select pos, 'stock', case when clean_stock is null then 'int_type' else 'greater_than_equal' end
    from facts where not crash and (clean_stock is null or clean_stock < 0)
  union all select pos, 'brand', 'string_type' from facts where not crash and brand = '5'),
good as (select * from facts where pos not in (select pos from errors))
"""
# What the fragments of a good record mean.
CLEAN = """clean_price as price,
  case when discount = '"7.25"' then 7.25::double when discount = '"x"' then null else 12.5::double end as discount_percentage,
  cast(rating as double) as rating, clean_stock as stock, regexp_replace(brand, '"', '', 'g') as brand,
  case when dimensions like '{%' then cast(json_extract(dimensions, '$.width') as double) end as width,
  case when dimensions like '{%' then 2.5::double end as height, cast(null as double) as depth,
  regexp_replace(availability, '"', '', 'g') as availability_status,
  case when pos % 2 = 0 then 'b1' else 'b2' end as barcode"""
TAGS = """case when tags is null or tags in ('null', '[]') then '' when tags = '"solo"' then 'solo'
  else regexp_replace(regexp_replace(tags, '[][" ]', '', 'g'), ',', ',', 'g') end"""


@query(
    "flatten_products",
    """select pos, id, title, try_cast(price as double) as price, discount as discount_percentage, dimensions is not null and dimensions like '{%' as has_width,
      case when meta like '{%' then json_extract_string(meta, '$.barcode') end as barcode,
      availability is not null as has_availability from (""" + PRODUCT_PARTS + """) p""",
)
def flatten_products(spark, sf_dir):
    flat = products(spark, sf_dir).selectExpr("pos", *flatten_columns("document"))
    return flat.selectExpr(
        "pos",
        "to_json(id) as id",
        "to_json(title) as title",
        "case when schema_of_variant(price) != 'STRING' then cast(price as double) end as price",
        "to_json(discount_percentage) as discount_percentage",
        "width is not null as has_width",
        "cast(barcode as string) as barcode",
        "availability_status is not null as has_availability",
    )


@query("product_errors", EXPECTED + "select field_name, error_code, count(*) as n from errors group by all")
def product_errors(spark, sf_dir):
    return error_counts(checked_products(spark, sf_dir).checked)


@query(
    "validate_products",
    EXPECTED
    + f"""select pos, cast(clean_id as varchar) as record_id, clean_id as id, regexp_replace(title, '"', '', 'g') as title, {CLEAN},
      case when tags is null or tags in ('null', '[]') then 0 when tags = '"solo"' then 1 else 2 end as n_tags,
      case when pos % 2 = 0 then epoch_us(timestamp '2024-05-23 08:56:21.618') else epoch_us(timestamp '2024-05-23 08:56:00') end
        as created_us, cast(null as bigint) as updated_us from good""",
)
def validate_products(spark, sf_dir):
    plain = "price discount_percentage rating stock brand width height depth availability_status barcode".split()
    return checked_products(spark, sf_dir).accepted.selectExpr(
        "pos",
        "record_id",
        "record.id",
        "record.title",
        *[f"record.{c}" for c in plain],
        "size(record.tags.items) as n_tags",
        "unix_micros(record.created_at.at) as created_us",
        "unix_micros(record.updated_at.at) as updated_us",
    )


@query(
    "canonical_products",
    EXPECTED
    + f"""select clean_id as product_id, title_text as title, regexp_replace(description, '"', '', 'g') as description,
      regexp_replace(category, '"', '', 'g') as category, {CLEAN}, {TAGS} as tags,
      availability is distinct from '"Out of Stock"' as in_stock,
      case when pos % 2 = 0 then '2024-05-23 08:56:21.618000+00:00' else '2024-05-23 08:56:00' end as created_at,
      cast(null as varchar) as updated_at, cast(null as varchar) as sku, cast(null as double) as weight,
      cast(null as varchar) as warranty_information, cast(null as varchar) as shipping_information,
      cast(null as varchar) as return_policy, cast(null as bigint) as minimum_order_quantity,
      cast(null as varchar) as thumbnail, 'api_source' as source, 'api' as source_type, '{RUN_TEXT}' as validated_at
      from good where tags is distinct from '["a", 3]'""",
)
def canonical_products(spark, sf_dir):
    accepted = checked_products(spark, sf_dir).accepted
    return transform(accepted, API, RUN_TS).transformed.select("canonical_record.*")


@query(
    "transform_rejects",
    EXPECTED
    + """select cast(clean_id as varchar) as record_id, 'api_source' as source_name, 'api' as source_type,
      concat('Unable to transform record ', clean_id, ': sequence item 1: expected str instance, int found') as error
      from good where tags = '["a", 3]'""",
)
def transform_rejects(spark, sf_dir):
    return transform(checked_products(spark, sf_dir).accepted, API, RUN_TS).rejected


@query(
    "transform_summary",
    EXPECTED
    + f"""select count(*) as processed, count(*) filter (tags is distinct from '["a", 3]') as accepted,
      count(*) filter (tags = '["a", 3]') as rejected, false as strict_mode, '{RUN_TEXT}' as transformed_at from good""",
)
def transform_summary(spark, sf_dir):
    return transform(checked_products(spark, sf_dir).accepted, API, RUN_TS).summary()


# --- single coercions ---------------------------------------------------------------


@query(
    "coerce_float",
    EXPECTED + "select pos, clean_price as value, case when clean_price is null then 'float_type'"
    " when clean_price < 0 then 'greater_than_equal' end as error_code from facts",
)
def coerce_float(spark, sf_dir):
    found = apply_rule(products(spark, sf_dir), "price", rules.required_float, "document")
    return found.select("pos", "value", "error_code")


@query(
    "coerce_int",
    EXPECTED + "select pos, clean_stock as value, case when clean_stock is null then 'int_type'"
    " when clean_stock < 0 then 'greater_than_equal' end as error_code from facts",
)
def coerce_int(spark, sf_dir):
    found = apply_rule(products(spark, sf_dir), "stock", rules.required_count, "document")
    return found.select("pos", "value", "error_code")


@query(
    "coerce_tags",
    EXPECTED
    + f"""select pos, {TAGS} as joined, case when tags = '["a", 3]' then
      'sequence item 1: expected str instance, int found' end as fault from facts""",
)
def coerce_tags(spark, sf_dir):
    found = apply_rule(products(spark, sf_dir), "tags", rules.tag_list, "document")
    return found.selectExpr("pos", "array_join(value.items, ',') as joined", "value.fault")


@query(
    "coerce_timestamp",
    """select event_id, epoch_us(ts) as at_us, true as zoned, strftime(ts, '%Y-%m-%d %H:%M:%S.%f+00:00') as shown
      from events where epoch_us(ts) % 1000000 != 0
      union all select event_id, epoch_us(ts), true, strftime(ts, '%Y-%m-%d %H:%M:%S+00:00') from events
      where epoch_us(ts) % 1000000 = 0""",
)
def coerce_timestamp(spark, sf_dir):
    text = """select event_id, to_variant_object(named_struct('at',
      concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z'))) as document from events"""
    found = apply_rule(sql(spark, sf_dir, text, "events"), "at", rules.optional_moment, "document")
    return found.selectExpr(
        "event_id", "unix_micros(value.at) as at_us", "value.zoned", "value.shown"
    )
