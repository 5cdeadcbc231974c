"""Messy inputs derived from the given tables, as SQL that Spark and DuckDB both run.

Each value range hits one branch of a rule. Documents are built from fragments:
one column per field with the JSON text of its value, NULL for an absent key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltgate.session import configure, new_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register the named tables as views."""
    configure(spark)
    for n in names or TABLES:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


def sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    tables(spark, sf_dir, *names)
    return spark.sql(text)


_landed: dict[tuple[str, str, str], str] = {}


def land(spark: SparkSession, sf_dir: str, label: str, text: str, *names: str) -> DataFrame:
    """The rows of ``text`` as files in the shared folder, written once per application.

    A table of fewer splits than cores is spread out; larger ones stay as they are.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _landed:
        rows = sql(spark, sf_dir, text, *names)
        cores = spark.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() < cores:
            rows = rows.repartition(cores)
        path = new_path(spark, label)
        rows.write.parquet(path)
        _landed[key] = path
    return spark.read.parquet(_landed[key])


def land_files(spark: SparkSession, sf_dir: str, label: str, write, text: str, *names: str) -> str:
    """A folder that ``write(rows, folder)`` has filled from the rows of ``text``, once per application.

    The rows of the first table are dealt over all cores: a Parquet file's row groups, which no
    task shares, can be fewer, and a written file may be read by one task only.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _landed:
        path = new_path(spark, label)
        tables(spark, sf_dir, *names)
        first = spark.table(names[0])
        tasks = max(first.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
        first.repartition(tasks).createOrReplaceTempView(names[0])
        write(spark.sql(text), path)
        _landed[key] = path
    return _landed[key]


# --- CSV users, from customer and nation --------------------------------------

USERS = """
select c_custkey as pos,
  case when c_custkey % 89 = 88 then '  ' else concat('CSV', lpad(cast(c_custkey as string), 8, '0')) end as user_id,
  case when c_custkey % 61 = 60 then '' else c_name end as full_name,
  case when c_custkey % 50 = 1 then '' when c_custkey % 47 = 1 then 'no-at-sign'
       when c_custkey % 43 = 1 then 'x@nodot' when c_custkey % 41 = 1 then 'a@b@c.com'
       else concat(' u', cast(c_custkey as string), '@example.org') end as email,
  case when c_custkey % 8 = 0 then ' ' else concat('555-', lpad(cast(c_custkey as string), 7, '0')) end as phone,
  case when c_custkey % 31 = 1 then '2024-02-30' when c_custkey % 29 = 1 then '2024-1-5'
       when c_custkey % 27 = 1 then '20240105'
       else concat('2024-', lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-15') end as signup_date,
  n_name as country,
  case c_custkey % 12 when 0 then '-1' when 1 then '' when 2 then '33.9' when 3 then 'banana' when 4 then '200'
       when 5 then '0.5' when 6 then ' 40 ' when 7 then '1e2' when 8 then '150.9'
       when 9 then case when c_custkey % 97 = 9 then 'inf' else 'nan' end
       else cast(18 + c_custkey % 60 as string) end as age,
  case c_custkey % 11 when 0 then 'Active' when 1 then ' inactive ' when 2 then 'suspended' when 3 then 'bogus'
       else 'pending' end as status,
  case c_custkey % 7 when 0 then 'Yes' when 1 then 'N' when 2 then '' when 3 then 'maybe' when 4 then ' 0 '
       else 'TRUE' end as newsletter_opt_in
from customer join nation on c_nationkey = n_nationkey
"""

# --- document users, from customer and nation ---------------------------------

DOCUMENT_PARTS = """
select c_custkey as pos,
  case when c_custkey % 41 = 1 then 'null' when c_custkey % 37 = 1 then '"x7"' when c_custkey % 31 = 1 then '5.5'
       when c_custkey % 29 = 1 then concat('"', cast(c_custkey as string), '.0"') when c_custkey % 23 = 1 then null
       when c_custkey % 19 = 1 then 'true' else cast(c_custkey as string) end as user_id,
  case when c_custkey % 43 = 2 then 'null' when c_custkey % 47 = 2 then '"  "' when c_custkey % 53 = 2 then null
       else concat('" ', c_name, '"') end as first_name,
  case when c_custkey % 59 = 2 then '7' else concat('"', c_mktsegment, '"') end as last_name,
  case when c_custkey % 50 = 3 then '""' when c_custkey % 47 = 3 then '"no-at-sign"' when c_custkey % 43 = 3 then 'null'
       else concat('"u', cast(c_custkey as string), '@example.org"') end as email,
  case when c_custkey % 8 = 0 then '" "' when c_custkey % 8 = 1 then 'null' when c_custkey % 8 = 2 then null
       else concat('"555', cast(c_custkey as string), '"') end as phone,
  case when c_custkey % 67 = 4 then '" "' when c_custkey % 61 = 4 then 'null' else '"F"' end as gender,
  case when c_custkey % 31 = 4 then '"1990-02-30"' when c_custkey % 29 = 4 then '"1990-1-5"'
       else concat('"1990-', lpad(cast(1 + c_custkey % 12 as string), 2, '0'), '-15"') end as date_of_birth,
  concat('"', n_name, ' city"') as city,
  case when c_custkey % 71 = 5 then null else concat('"', n_name, '"') end as country,
  concat('"', cast(c_custkey as string), ' Main St"') as address,
  case c_custkey % 9 when 0 then 'true' when 1 then 'false' when 2 then '"Yes"' when 3 then '"y"' when 4 then '0'
       when 5 then '7' when 6 then '1.0' else 'true' end as is_active,
  '"web"' as signup_source,
  case when c_custkey % 73 = 6 then '""' else '"free"' end as membership,
  case when c_custkey % 79 = 7 then '"yesterday"' when c_custkey % 17 = 7 then '"2024-03-01T10:00:00"'
       else '"2024-03-01T10:00:00+00:00"' end as created_at,
  case when c_custkey % 13 = 8 then '"2024-02-29T23:59:59Z"' when c_custkey % 17 = 7 and c_custkey % 2 = 0
       then '"2024-03-02T10:00:00.250"' else '"2024-03-02T12:30:00.500+02:00"' end as updated_at
from customer join nation on c_nationkey = n_nationkey
"""
DOCUMENT_FIELDS = (
    "user_id first_name last_name email phone gender date_of_birth city country address"
    " is_active signup_source membership created_at updated_at"
).split()


def _json(fields: dict[str, str]) -> str:
    """SQL for a JSON object of fragments; NULL fragments are left out."""
    parts = [f"concat('\"{key}\": ', {column})" for key, column in fields.items()]
    return f"concat('{{', concat_ws(', ', {', '.join(parts)}), '}}')"


DOCUMENT_ID = "concat('{\"$oid\": \"', lpad(cast(pos as string), 24, '0'), '\"}')"
DOCUMENTS = f"""
select pos, case when pos % 83 = 82 then '{{not json' when pos % 97 = 96 then '[1, 2]'
  else {_json({"_id": DOCUMENT_ID, **{f: f for f in DOCUMENT_FIELDS}})} end as line
from ({DOCUMENT_PARTS}) parts
"""

# --- products, from part --------------------------------------------------------

PRODUCT_PARTS = """
select p_partkey as pos,
  case when p_partkey % 41 = 1 then '"abc"' when p_partkey % 37 = 1 then null else cast(p_partkey as string) end as id,
  case when p_partkey % 43 = 2 then '""' when p_partkey % 47 = 2 then null else concat('" ', p_name, '"') end as title,
  concat('"', p_brand, ' product"') as description,
  case when p_partkey % 53 = 2 then '5' else concat('"', p_type, '"') end as category,
  case when p_partkey % 31 = 3 then '-1.0' when p_partkey % 29 = 3 then '"12.5"' when p_partkey % 23 = 3 then '"abc"'
       else cast(p_retailprice as string) end as price,
  case when p_partkey % 11 = 0 then '"7.25"' when p_partkey % 11 = 1 then '"x"' else '12.5' end as discount,
  case when p_partkey % 13 = 0 then null else '4.5' end as rating,
  case p_partkey % 17 when 0 then '5.7' when 1 then '"5.7"' when 2 then '"7"' when 3 then '-2' when 4 then 'null'
       else cast(p_size as string) end as stock,
  case p_partkey % 19 when 0 then 'null' when 1 then '"solo"' when 2 then '["a", 3]' when 3 then '[]' when 4 then null
       else concat('["', p_type, '", "', p_brand, '"]') end as tags,
  case when p_partkey % 59 = 4 then '5' else concat('"', p_brand, '"') end as brand,
  case p_partkey % 61 when 5 then '[1]' when 6 then '[]' when 7 then null
       else concat('{"width": ', cast(p_size as string), ', "height": 2.5, "depth": "wide"}') end as dimensions,
  case p_partkey % 3 when 0 then '"In Stock"' when 1 then '"Out of Stock"' else null end as availability,
  case when p_partkey % 67 = 8 then '"none"'
       when p_partkey % 2 = 0 then '{"barcode": "b1", "createdAt": "2024-05-23T08:56:21.618Z", "updatedAt": "soon"}'
       else '{"barcode": "b2", "createdAt": "2024-05-23 08:56"}' end as meta
from part
"""
PRODUCT_KEYS = {
    "id": "id",
    "title": "title",
    "description": "description",
    "category": "category",
    "price": "price",
    "discountPercentage": "discount",
    "rating": "rating",
    "stock": "stock",
    "tags": "tags",
    "brand": "brand",
    "dimensions": "dimensions",
    "availabilityStatus": "availability",
    "meta": "meta",
}
PRODUCTS = f"select pos, {_json(PRODUCT_KEYS)} as line from ({PRODUCT_PARTS}) parts"

# --- landed pages, from part ------------------------------------------------------

# A source holds 700 parts, a page 30 of them; some bodies are broken.
SOURCE_SIZE, PAGE_SIZE = 700, 30
PAGE_ROWS = f"""
select concat('api', lpad(cast(cast(floor(p_partkey / {SOURCE_SIZE}) as int) as string), 6, '0')) as source,
  cast(floor(p_partkey / {SOURCE_SIZE}) as int) as source_no,
  cast(floor((p_partkey % {SOURCE_SIZE}) / {PAGE_SIZE}) as bigint) as page_index,
  p_partkey as pos, concat('{{"id": ', cast(p_partkey as string), '}}') as item
from part
"""
PAGE_TOTAL = """case source_no % 4 when 0 then '200' when 1 then '"many"' when 2 then '10000' else 'true' end"""
PAGE_STATE = """case when source_no % 5 = 1 and page_index = 9 then 'broken' when source_no % 5 = 2 and page_index = 12
  then 'nopath' when source_no % 5 = 3 and page_index = 3 then 'scalar' else 'fine' end"""
LANDED = f"""
select source, page_index, concat('https://example.org/', source, '?skip=', cast(page_index * {PAGE_SIZE} as string)) as url,
  200 as status,
  case {PAGE_STATE} when 'broken' then '{{"products": [' when 'nopath' then '{{"items": []}}'
    when 'scalar' then '{{"data": {{"products": 5}}}}'
    else concat('{{"data": {{"products": [', items, ']}}, "total": ', {PAGE_TOTAL}, '}}') end as body
from (
  select source, source_no, page_index,
    array_join(transform(array_sort(collect_list(struct(pos, item))), x -> x.item), ', ') as items
  from ({PAGE_ROWS}) page_rows group by source, source_no, page_index
) grouped
"""
# The same pages for checking: how each body reads, without the bodies.
PAGE_FACTS = f"""
select source, source_no, page_index, {PAGE_STATE} as state, {PAGE_TOTAL} as total_json, count(*) as n_items
from ({PAGE_ROWS}) page_rows group by source, source_no, page_index
"""

# --- API response log, from part ---------------------------------------------------

# An API holds 120 parts, a page 10 of them; what goes wrong depends on the API.
API_SIZE, API_PAGE = 120, 10
API_ROWS = f"""
select concat('log', lpad(cast(cast(floor(p_partkey / {API_SIZE}) as int) as string), 6, '0')) as source,
  cast(floor(p_partkey / {API_SIZE}) as int) % 6 as kind,
  cast(floor((p_partkey % {API_SIZE}) / {API_PAGE}) as bigint) as page_index,
  p_partkey as pos, concat('{{"id": ', cast(p_partkey as string), '}}') as item
from part
"""
API_ATTEMPTS = """case when kind = 0 and page_index % 2 = 0 then 2 when kind = 2 and page_index = 4 then 5
  when kind = 4 and page_index = 3 then 0 when kind = 5 and page_index = 1 then 2 else 1 end"""
API_STATUS = """case when kind = 0 and page_index % 2 = 0 and attempt = 1 then 503 when kind = 1 and page_index = 5 then 404
  when kind = 2 and page_index = 4 and attempt <= 4 then 503 when kind = 5 and page_index = 1 and attempt = 1 then null else 200 end"""
API_LOG = f"""
select source, page_index, attempt, {API_STATUS} as status,
  concat('https://example.org/', source, '?skip=', cast(page_index * {API_PAGE} as string)) as url,
  case when coalesce({API_STATUS}, 0) != 200 then 'try later'
    when kind = 3 and page_index = 6 then '{{"data": ['
    else concat('{{"data": {{"products": [', items, ']}}, "total": ', case when kind = 5 then '35' else '10000' end, '}}') end as body
from (
  select source, kind, page_index, array_join(transform(array_sort(collect_list(struct(pos, item))), x -> x.item), ', ') as items
  from ({API_ROWS}) api_rows group by source, kind, page_index
) grouped lateral view explode(sequence(1, 5)) steps as attempt
where attempt <= {API_ATTEMPTS}
"""
# All products as the pages of one API, each landed at its first attempt.
PRODUCT_LOG = f"""
select 'products' as source, cast(floor(pos / {PAGE_SIZE}) as bigint) as page_index, 1 as attempt, 200 as status,
  'https://example.org/products' as url,
  concat('{{"products": [', array_join(transform(array_sort(collect_list(struct(pos, line))), x -> x.line), ', '), ']}}') as body
from ({PRODUCTS}) lines group by cast(floor(pos / {PAGE_SIZE}) as bigint)
"""

# --- response log, from events ----------------------------------------------------

RESPONSES = """
select concat('s', cast(floor(event_id / 5) % 7 as int)) as source, cast(floor(event_id / 5) as bigint) as page_index,
  cast(event_id % 5 + 1 as int) as attempt,
  case when event_id % 211 = 3 then 401
       else case event_type when 'view' then 200 when 'signup' then 503 when 'click' then 429 when 'purchase' then 404 end
       end as status,
  props as body
from events
"""

# --- CSV files, from customer -------------------------------------------------------

# Files of 400 data rows; the row kinds depend on the key.
FILE_ROWS = """
select cast(floor(c_custkey / 400) as bigint) as file_no,
  c_custkey as pos,
  case when c_custkey % 83 = 5 then 'short' when c_custkey % 71 = 6 then 'blank'
       when c_custkey % 701 = 650 then 'long' when c_custkey % 61 = 7 then 'padded'
       when c_custkey % 53 = 8 then 'quoted' else 'plain' end as kind,
  c_name as name, c_mktsegment as segment
from customer
"""
FILE_LINES = f"""
select file_no, pos, case kind when 'short' then cast(pos as string) when 'blank' then ' , ,'
    when 'long' then concat(cast(pos as string), ',x,y,z')
    when 'padded' then concat(' ', cast(pos as string), ' ,', name, ' , ', segment)
    when 'quoted' then concat(cast(pos as string), ',"', name, ', ""jr""\n second line",', segment)
    else concat(cast(pos as string), ',', name, ',', segment) end as line
from ({FILE_ROWS}) file_rows
union all
select distinct file_no, -1 as pos, 'id, name ,segment' as line from ({FILE_ROWS}) file_rows
"""
