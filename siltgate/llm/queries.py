"""One query per operator, each over its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import (
    example_packing,
    html_text,
    mixing,
    packing,
    periodic_runs,
    shards,
    simhash,
    small_world,
    toxicity,
    transcripts,
    tree_index,
    url_rules,
    vector_codes,
)
from siltgate.llm import oracles
from siltgate.llm.common import stage, table
from siltgate.llm.registry import query


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_columns(docs, model, "doc_id")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


# The rules of the URL filter.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
URL_RULES_SQL = """
with places as (
  select page_id, case when url like '%://%' then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from places
), rules(verdict, rule, rule_host, rule_path) as (
  values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
)
select page_id, host, path,
  (select arg_max(rule, length(rule)) from rules
   where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as rule,
  coalesce((select arg_max(verdict, length(rule)) from rules
   where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)), 'allow') as verdict
from parts
"""


@query("op7_url_filters", URL_RULES_SQL)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_frame(spark, URL_RULES)
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shard(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op2_nearest")
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_index.nearest(table(spark, sf_dir, "embeddings"))


@query("op4_html_text")
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_world.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op5_chat_formatting")
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as transcripts, their roles recovered, and rendered turn by turn."""
    lines = stage(transcripts.from_turns(table(spark, sf_dir, "conversations")), "lines")
    model = transcripts.train(lines)
    return transcripts.turns(transcripts.recover(lines, model))


@query("op11_example_packing")
def op11_example_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = example_packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op12_vector_codes", oracles.VECTOR_CODES)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(stage(found.rows, "codes"))
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def repeats_put_in(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's change of one document in ten: from some word on, a stretch over and over."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + period]
    return words[:a] + (stretch * (-(-(n - a) // period)))[: n - a]


@query("op13_periodic_runs", oracles.PERIODIC_RUNS)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without a doc_id keeps its words as they are."""
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), prepare=repeats_put_in)
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", F.array_max(ranked)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
