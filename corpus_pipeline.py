"""From documents to packed training sequences: toxicity, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.llm import mixing, packing, simhash, toxicity
from siltgate.llm.common import stage, table

# The classifier, the fingerprints and the packing are no SQL; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model does not reject, with all their columns, rows and nulls.

    The model learns from the labelled documents of ``sf_dir``, held-out fold left out.
    """
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id.

    Of rows that share that id, one stays. Null ids come after all others. Texts without words
    form one group.
    """
    found = stage(simhash.near_duplicates(docs), "near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp"))
    kept = found.groupBy("root").agg(first.alias("first")).select("first.doc_id", "first.fp")
    # Most ids are in the table once; then the id alone tells the row. A null id tells none.
    copies = found.groupBy("doc_id").agg(((F.count("*") > 1) | F.col("doc_id").isNull()).alias("shared"))
    marked = stage(kept.join(copies, kept["doc_id"].eqNullSafe(copies["doc_id"])).select(kept["doc_id"], "fp", "shared"), "kept")
    alone = docs.join(marked.where("not shared").select("doc_id"), "doc_id", "left_semi")
    shared = marked.where("shared")
    ids = shared.select("doc_id").distinct()
    rows = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").withColumn(
        "_fp", simhash.fingerprint_of(F.col("text"))
    )
    one = Window.partitionBy("doc_id", "_fp").orderBy(F.xxhash64("text"))
    rows = rows.join(
        shared.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_kept")),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_fp") == F.col("_kept")),
        "left_semi",
    )
    again = rows.withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return alone.select(docs.columns).unionAll(again.select(docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a document as often as it is taken, up to twice.

    The one document of a source where the draw ends is cut after its last taken word (its words
    are then one space apart), and its ``n_chars``, if there is one, is that of the cut text. Documents that are not drawn, or
    have no words, go; so an empty table, or one of null and blank texts, gives no rows. Other columns may have any name.
    """
    placed = mixing.mix(docs).where("taken > 0")
    # Rows equal in id, text and source share a hash; what is taken of each is told apart by number.
    by_row = Window.partitionBy("row").orderBy(F.desc("taken"))
    counts = placed.groupBy("row").agg(F.count("*").alias("_rows"))
    takes = placed.join(counts, "row")
    once = takes.where("_rows = 1").select("row", "size", "taken")
    several = takes.where("_rows > 1").select("row", "size", "taken", F.row_number().over(by_row).alias("_number"))
    # A document stays in one column, so its columns may have any name.
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), mixing.row_hash().alias("row"))
    single = marked.join(once, "row").select("doc", "size", "taken")
    rows_of_several = marked.join(several.select("row").distinct(), "row", "left_semi").withColumn(
        "_number", F.row_number().over(Window.partitionBy("row").orderBy(F.to_json("doc")))
    )
    repeated = rows_of_several.join(several, ["row", "_number"]).select("doc", "size", "taken")
    passes = F.expr("array_repeat(size, cast(taken div size as int))")
    part = F.expr("taken % size")
    words = F.concat(passes, F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    drawn = single.unionAll(repeated).select("doc", "size", F.explode(words).alias("words"))
    whole = F.col("words") == F.col("size")
    every = F.filter(F.split("doc.text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    first_words = F.array_join(F.slice(every, 1, F.col("words").cast("int")), " ")
    cut = drawn.withColumn("text", F.when(whole, F.col("doc.text")).otherwise(first_words))
    changed = {
        "text": F.col("text"),
        "n_chars": F.when(whole, F.col("doc")["n_chars"]).otherwise(F.length("text")) if "n_chars" in docs.columns else None,
    }
    return cut.select(*[changed[c].alias(c) if c in changed else F.col("doc")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence of at most 2,048 tokens."""
    packed = packing.pack_documents(docs)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
