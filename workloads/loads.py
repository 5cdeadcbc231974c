"""Incremental filters, checkpoints, keyed loads and target types."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltgate.fixed_values import TARGET_TABLES
from siltgate.functions import redact
from siltgate.operators.canonical import flatten
from siltgate.operators.incremental import (
    filter_counts,
    keep_new,
    keep_new_by_source,
    next_checkpoint,
)
from siltgate.operators.keys import assign_keys
from siltgate.operators.upsert import (
    existing_keys,
    last_wins,
    mark_existing,
    new_records,
    payload_rows,
    skipped_records,
    upsert,
)
from siltgate.plans.load import load, load_summary, upsert_checkpoint
from siltgate.session import new_path
from siltgate.sinks.buckets import BucketedTable
from siltgate.sinks.tables import TargetTable, create_statement, evolve, insert_rows, to_target
from workloads.inputs import sql
from workloads.registry import RUN_TEXT, RUN_TS, query
from workloads.users import USERS, users

# --- incremental filter ---------------------------------------------------------------


@query(
    "incremental_numeric",
    "select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey > 700",
)
def incremental_numeric(spark, sf_dir):
    orders = sql(spark, sf_dir, "select o_orderkey, o_custkey, o_totalprice from orders", "orders")
    return keep_new(orders, "o_orderkey", "700")


# Ids of every form: numbers as text, spaced, grouped, words and nothing.
MIXED_IDS = """select event_id, case event_id % 5 when 0 then cast(event_id as string)
  when 1 then concat(' ', cast(event_id as string), ' ') when 2 then concat('evt', lpad(cast(event_id as string), 12, '0'))
  when 3 then concat('+', cast(event_id as string)) else null end as id from events"""


@query(
    "incremental_text",
    f"""select event_id, id from ({MIXED_IDS}) ids
      where id is null or event_id % 5 in (0, 1, 3) or id > 'evt000000000300'""",
)
def incremental_text(spark, sf_dir):
    return keep_new(sql(spark, sf_dir, MIXED_IDS, "events"), "id", "evt000000000300")


@query(
    "incremental_mixed",
    f"""select event_id, id from ({MIXED_IDS}) ids
      where id is null or event_id % 5 = 2 or event_id > 300""",
)
def incremental_mixed(spark, sf_dir):
    return keep_new(sql(spark, sf_dir, MIXED_IDS, "events"), "id", "300")


@query("incremental_no_checkpoint", f"select event_id, id from ({MIXED_IDS}) ids")
def incremental_no_checkpoint(spark, sf_dir):
    return keep_new(sql(spark, sf_dir, MIXED_IDS, "events"), "id", None)


MARKS = """select event_type as source_name, cast(cast(floor(max(event_id) / 2) as bigint) as string) as last_processed_id
  from events where event_type != 'error' group by event_type"""


@query(
    "incremental_by_source",
    f"""select event_id, event_type from events left join ({MARKS}) m on event_type = m.source_name
      where m.last_processed_id is null or event_id > cast(m.last_processed_id as bigint)""",
)
def incremental_by_source(spark, sf_dir):
    events = sql(spark, sf_dir, "select event_id, event_type from events", "events")
    return keep_new_by_source(events, spark.sql(MARKS), "event_id", "event_type")


@query(
    "incremental_counts",
    f"""select count(*) as total_found, count(*) filter (id is null or event_id % 5 = 2 or event_id > 300) as new,
      count(*) filter (not (id is null or event_id % 5 = 2 or event_id > 300)) as skipped from ({MIXED_IDS}) ids""",
)
def incremental_counts(spark, sf_dir):
    return filter_counts(sql(spark, sf_dir, MIXED_IDS, "events"), "id", "300")


# --- checkpoints --------------------------------------------------------------------------


@query(
    "checkpoint_numeric",
    "select l_returnflag, cast(max(l_orderkey) as varchar) as last_processed_id from lineitem group by l_returnflag",
)
def checkpoint_numeric(spark, sf_dir):
    lines = sql(spark, sf_dir, "select l_returnflag, l_orderkey from lineitem", "lineitem")
    return next_checkpoint(lines, "l_orderkey", by="l_returnflag")


@query(
    "checkpoint_text",
    f"select max(user_id) as last_processed_id from ({USERS}) raw",
)
def checkpoint_text(spark, sf_dir):
    return next_checkpoint(users(spark, sf_dir), "user_id")


CHECKPOINTS = f"""select event_type as source_name, timestamp '2024-01-01 00:00:00' as last_successful_run,
  cast(max(event_id) as string) as last_processed_id, timestamp '2024-01-01 00:00:00' as last_processed_timestamp,
  timestamp '2024-01-01 00:00:00' as updated_at from events where event_type not in ('error', 'view') group by event_type"""
NEXT = """select event_type as source_name, case when event_type = 'click' then '5'
  else cast(max(event_id) + 10 as string) end as last_processed_id from events where event_type != 'signup' group by event_type"""


@query(
    "checkpoint_upsert",
    f"""select coalesce(n.source_name, o.source_name) as source_name, case when n.last_processed_id is null then o.last_processed_id
      when o.last_processed_id is null or cast(n.last_processed_id as bigint) >= cast(o.last_processed_id as bigint)
      then n.last_processed_id else o.last_processed_id end as last_processed_id,
      n.source_name is not null as touched from ({CHECKPOINTS}) o full join ({NEXT}) n on o.source_name = n.source_name""",
)
def checkpoint_upsert(spark, sf_dir):
    old = sql(spark, sf_dir, CHECKPOINTS, "events")
    now = f"to_timestamp('{RUN_TEXT}')"
    rows = spark.sql(NEXT).selectExpr(
        "source_name", f"{now} as last_successful_run", "last_processed_id",
        f"{now} as last_processed_timestamp", f"{now} as updated_at",
    )
    return upsert_checkpoint(old, rows).selectExpr(
        "source_name", "last_processed_id", f"updated_at = {now} as touched"
    )


# --- keyed loads ------------------------------------------------------------------------------

BATCH = "select c_custkey as user_id, c_name as name, c_acctbal as balance from customer"
TARGET = "select user_id, value, event_type from events"


@query("existing_keys", "select distinct cast(user_id as varchar) as user_id from events where user_id is not null")
def existing(spark, sf_dir):
    return existing_keys(sql(spark, sf_dir, TARGET, "events"), "user_id")


@query(
    "new_records_only",
    f"select * from ({BATCH}) b where user_id not in (select user_id from events)",
)
def new_records_only(spark, sf_dir):
    return new_records(sql(spark, sf_dir, BATCH, "customer"), sql(spark, sf_dir, TARGET, "events"), "user_id")


@query(
    "skipped_records",
    f"select * from ({BATCH}) b where user_id in (select user_id from events)",
)
def skipped(spark, sf_dir):
    return skipped_records(sql(spark, sf_dir, BATCH, "customer"), sql(spark, sf_dir, TARGET, "events"), "user_id")


ORDERS = "select o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_orderdate from orders"
LATEST = """select o_custkey, o_orderkey, o_totalprice, o_orderstatus from (select *, row_number() over
  (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) ranked where rn = 1"""


@query("dedupe_last_wins", LATEST)
def dedupe_last_wins(spark, sf_dir):
    orders = sql(spark, sf_dir, ORDERS, "orders")
    return last_wins(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


CUSTOMERS = "select c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer"


@query(
    "upsert_flat",
    f"""with latest as (select o_custkey * 2 as id, o_totalprice as balance, o_orderstatus as status from ({LATEST}) l)
      select coalesce(l.id, c.id) as id, c.name, case when l.id is not null then l.balance else c.balance end as balance,
      c.segment, l.status from ({CUSTOMERS}) c full join latest l on c.id = l.id""",
)
def upsert_flat(spark, sf_dir):
    target = sql(spark, sf_dir, CUSTOMERS, "customer")
    batch = dedupe_last_wins(spark, sf_dir).selectExpr(
        "o_custkey * 2 as id", "o_totalprice as balance", "o_orderstatus as status"
    )
    return upsert(target, batch, "id")


@query(
    "upsert_payload",
    """select s_suppkey as key, to_json({'key': s_suppkey, 'name': s_name, 'nation': s_nationkey,
      'flag': case when s_suppkey % 3 = 0 then null else true end}) as payload, true as fresh from supplier
      union all select n_nationkey + (select max(s_suppkey) + 1 from supplier), concat('{"nation":"', n_name, '"}'), false from nation""",
)
def upsert_payload(spark, sf_dir):
    rows = """select s_suppkey as key, s_name as name, s_nationkey as nation,
      case when s_suppkey % 3 = 0 then null else true end as flag from supplier"""
    batch = payload_rows(sql(spark, sf_dir, rows, "supplier"), "key", RUN_TEXT)
    # The target holds every nation, and older payloads of every supplier.
    old = """select n_nationkey + (select max(s_suppkey) + 1 from supplier) as key, concat('{"nation":"', n_name, '"}') as payload,
      timestamp '2024-01-01 00:00:00' as updated_at from nation
      union all select s_suppkey, '{}', timestamp '2024-01-01 00:00:00' from supplier"""
    target = sql(spark, sf_dir, old, "nation", "supplier")
    return upsert(target, batch, "key").selectExpr(
        "key", "payload", f"updated_at = to_timestamp('{RUN_TEXT}') as fresh"
    )


@query(
    "load_summary",
    f"""select count(*) filter (user_id not in (select user_id from events)) as inserted, 0::bigint as updated,
      count(*) filter (user_id in (select user_id from events)) as skipped from ({BATCH}) b""",
)
def load_counts(spark, sf_dir):
    target = existing_keys(sql(spark, sf_dir, TARGET, "events"), "user_id")
    marked = mark_existing(sql(spark, sf_dir, BATCH, "customer"), target, "user_id", "known")
    return load_summary(marked, "known")


# Two loads into one table: every event's user first, then every customer twice over.
FIRST = """select 'w' as wrapper, cast(user_id as string) as record_id, named_struct('user_id', concat('C', cast(user_id as string)),
  'full_name', event_type, 'signup_date', cast(cast(ts as date) as string), 'seq', event_id) as canonical_record from events"""
SECOND = """select named_struct('user_id', concat('C', cast(c_custkey as string)), 'full_name', name, 'seq', seq) as canonical_record
  from (select c_custkey, c_name as name, 2 as seq from customer union all select c_custkey, 'first', 1 from customer) twice"""


@query(
    "load_twice",
    """with first as (select concat('C', user_id) as user_id, event_type as full_name, cast(ts as date) as signup_date
        from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events) r where rn = 1),
      second as (select concat('C', c_custkey) as user_id, c_name as full_name, null::date as signup_date from customer
        where concat('C', c_custkey) not in (select user_id from first)),
      marks as (select greatest((select max(user_id) from first), (select max(concat('C', c_custkey)) from customer)) as mark)
      select user_id, full_name, cast(signup_date as varchar) as signup_date, mark as last_processed_id,
        (select 2 * count(*) from second) as inserted, (select 2 * count(*) from customer where concat('C', c_custkey)
        in (select user_id from first)) as skipped from (select * from first union all select * from second) loaded, marks""",
)
def load_twice(spark, sf_dir):
    folder = new_path(spark, "targets")
    target = TargetTable.named(spark, folder, "etl_csv_users")
    checkpoints = TargetTable.named(spark, folder, "etl_metadata")
    load(sql(spark, sf_dir, FIRST, "events"), target, checkpoints, "csv_users", RUN_TS, ["seq"])
    counts = load(sql(spark, sf_dir, SECOND, "customer"), target, checkpoints, "csv_users", RUN_TS, ["seq"])
    mark = checkpoints.read().first()["last_processed_id"]
    return target.read().selectExpr(
        "user_id",
        "full_name",
        "cast(signup_date as string) as signup_date",
        f"'{mark}' as last_processed_id",
        f"{counts['inserted']}L as inserted",
        f"{counts['skipped']}L as skipped",
    )


@query(
    "load_upsert",
    """with first as (select concat('C', user_id) as user_id, event_type as full_name, cast(ts as date) as signup_date
        from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events) r where rn = 1),
      second as (select concat('C', c_custkey) as user_id, c_name as full_name from customer),
      marks as (select greatest((select max(user_id) from first), (select max(user_id) from second)) as mark)
      select coalesce(s.user_id, f.user_id) as user_id, coalesce(s.full_name, f.full_name) as full_name,
        cast(f.signup_date as varchar) as signup_date, mark as last_processed_id,
        (select count(*) from second where user_id not in (select user_id from first)) as inserted,
        (select count(*) from second where user_id in (select user_id from first)) as updated
      from first f full join second s on f.user_id = s.user_id, marks""",
)
def load_upsert(spark, sf_dir):
    """A bucketed table takes every event's user, then every customer over it."""
    folder = new_path(spark, "targets")
    target = BucketedTable.named(spark, folder, "etl_csv_users")
    checkpoints = TargetTable.named(spark, folder, "etl_metadata")
    load(sql(spark, sf_dir, FIRST, "events"), target, checkpoints, "csv_users", RUN_TS, ["seq"], "upsert")
    counts = load(sql(spark, sf_dir, SECOND, "customer"), target, checkpoints, "csv_users", RUN_TS, ["seq"], "upsert")
    mark = checkpoints.read().first()["last_processed_id"]
    return target.read().selectExpr(
        "user_id",
        "full_name",
        "cast(signup_date as string) as signup_date",
        f"'{mark}' as last_processed_id",
        f"{counts['inserted']}L as inserted",
        f"{counts['updated']}L as updated",
    )


# Customers' keys in three loads: the older half, the newer half, and all of them again.
HALVES = [
    f"select * from ({BATCH}) b where user_id {side} (select max(c_custkey) / 2 from customer)" for side in ("<", ">=")
]


@query(
    "insert_new_by_sketch",
    f"select user_id, full_name, 0::bigint as again from (select concat('C', lpad(cast(user_id as varchar), 9, '0')) as user_id, name as full_name from ({BATCH}) b) x",
)
def insert_new_by_sketch(spark, sf_dir):
    """Only folders whose range and sketch can hold a key are opened; a second run adds nothing."""
    target = BucketedTable.named(spark, new_path(spark, "targets"), "etl_csv_users")
    users_of = "concat('C', lpad(cast(user_id as string), 9, '0')) as user_id"
    for half in HALVES:
        rows = sql(spark, sf_dir, half, "customer").selectExpr(users_of, "name as full_name")
        target.insert_new(rows)
    every = sql(spark, sf_dir, BATCH, "customer").selectExpr(users_of, "'again' as full_name")
    again = target.insert_new(every).inserted
    return target.read().selectExpr("user_id", "full_name", f"{again}L as again")


@query(
    "loader_flatten",
    """select concat('C', user_id) as user_id, event_type as full_name, cast(cast(ts as date) as varchar) as signup_date,
      event_id as seq, cast(user_id as varchar) as product_id from events""",
)
def loader_flatten(spark, sf_dir):
    return flatten(sql(spark, sf_dir, FIRST, "events"), "product_id")


@query(
    "next_key",
    """select o_orderkey, (select max(c_custkey) from customer) + row_number() over (order by o_orderkey) as user_id from orders""",
)
def new_keys(spark, sf_dir):
    batch = sql(spark, sf_dir, "select o_orderkey from orders", "orders")
    existing_rows = sql(spark, sf_dir, "select c_custkey as user_id from customer", "customer")
    return assign_keys(batch, existing_rows, "user_id", "o_orderkey")


# --- target types -----------------------------------------------------------------------------


@query(
    "evolve_columns",
    "select s_suppkey as user_id, s_name as full_name, null::varchar as source, null::boolean as is_active from supplier",
)
def evolve_columns(spark, sf_dir):
    old = sql(spark, sf_dir, "select s_suppkey as user_id, s_name as full_name from supplier", "supplier")
    return evolve(old, "user_id long, full_name string, source string, is_active boolean")


@query(
    "target_types",
    """select l_orderkey as product_id, cast(cast(l_extendedprice as decimal(10, 2)) as varchar) as price,
      cast(try_cast(l_quantity as decimal(3, 2)) as varchar) as rating, cast(cast(l_tax as decimal(5, 2)) as varchar) as discount_percentage,
      case when l_quantity >= 10 then 'rating does not fit decimal(3,2)' end as fault from lineitem""",
)
def target_types(spark, sf_dir):
    lines = """select l_orderkey as product_id, l_extendedprice as price, l_quantity as rating, l_tax as discount_percentage
      from lineitem"""
    typed = to_target(sql(spark, sf_dir, lines, "lineitem"), TARGET_TABLES["etl_api_products"][1])
    return typed.rows.selectExpr(
        "cast(product_id as bigint) as product_id",
        "cast(price as string) as price",
        "cast(rating as string) as rating",
        "cast(discount_percentage as string) as discount_percentage",
        "fault",
    )


@query(
    "load_time_default",
    """select concat('C', c_custkey) as user_id, c_name as full_name, cast(null as varchar) as country, c_custkey % 2 = 0 as stamped_by_table
      from customer""",
)
def load_time_default(spark, sf_dir):
    """Rows without a load time get it from the table; rows with one keep it."""
    table, place = f"load_time_{uuid.uuid4().hex}", new_path(spark, "defaults")
    spark.sql(create_statement("etl_csv_users", place, table))
    rows = "select concat('C', cast(c_custkey as string)) as user_id, c_name as full_name from customer where c_custkey % 2 = {}"
    insert_rows(spark, table, sql(spark, sf_dir, rows.format(0), "customer"))
    stamped = sql(spark, sf_dir, rows.format(1), "customer").withColumn("updated_at", F.to_timestamp(F.lit(RUN_TEXT)))
    insert_rows(spark, table, stamped)
    schema = spark.table(table).schema
    spark.sql(f"drop table {table}")  # its files stay where they are
    return spark.read.schema(schema).parquet(place).selectExpr(
        "user_id", "full_name", "country", f"updated_at > to_timestamp('{RUN_TEXT}') as stamped_by_table"
    )


# --- redaction ----------------------------------------------------------------------------------


@query(
    "redact_columns",
    """select event_id, '[REDACTED]' as user_password, '[REDACTED]' as "API-Key", '[REDACTED]' as author, event_type as kind,
      value as amount from events""",
)
def redact_columns(spark, sf_dir):
    rows = """select event_id, cast(user_id as string) as user_password, props as `API-Key`, event_type as author,
      event_type as kind, value as amount from events"""
    return redact.redact_columns(sql(spark, sf_dir, rows, "events"))


@query(
    "redact_map",
    "select event_id, '[REDACTED]' as hidden, props as shown, '[REDACTED]' as auth from events",
)
def redact_map(spark, sf_dir):
    rows = """select event_id, map('Secret_x', cast(user_id as string), 'props', props, 'author', event_type) as entries
      from events"""
    hidden = sql(spark, sf_dir, rows, "events").withColumn("entries", F.expr(redact.redact_map("entries")))
    return hidden.selectExpr(
        "event_id", "entries['Secret_x'] as hidden", "entries['props'] as shown", "entries['author'] as auth"
    )
