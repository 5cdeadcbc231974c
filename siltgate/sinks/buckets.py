"""Target tables laid out by key hash, of which a load rewrites only what it touches.

A key belongs to one bucket, and a bucket's rows lie in one or more folders. A manifest names the
folders that make up the table, with each one's rows and smallest and largest key; beside it lies
a sketch of its keys. A load writes folders of its own first and a new manifest last, so a failed
load leaves the table as it was. Folders that neither the current manifest nor the one before
names are removed.

* ``upsert`` joins the batch with the touched buckets alone and rewrites those that hold one of
  its keys already; a bucket that only gains keys gets one more folder.
* ``insert_new`` opens only folders that can hold a key of the batch.

The hash is the one Spark deals rows by, so joined rows are where their bucket is written and a
load has one shuffle.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.fixed_values import TARGET_TABLES
from siltgate.functions.text import name
from siltgate.operators.upsert import INTEGRAL, upsert
from siltgate.session import stage
from siltgate.sources.files import child_names, exists, read_small, remove, write_small

BUCKETS = 32
FOLDERS = 8  # a bucket with so many is written anew by the next load that touches it
BUCKET = "silt_bucket"
MANIFEST = re.compile(r"^m(\d{9})\.json$")

# A sketch has so many bits a key, of which each key sets so many.
SKETCH_BITS, SKETCH_HASHES = 16, 4
MAP_BITS = 32_768  # of one bitmap


@dataclass(frozen=True)
class Folder:
    """One folder of one bucket; ``write`` names the load that made it, ``maps`` sizes its sketch."""

    bucket: int
    write: str
    rows: int
    smallest: int | str
    largest: int | str
    maps: int


@dataclass(frozen=True)
class Written:
    """Numbers of keys, and of the table's folders."""

    inserted: int
    updated: int
    known: int  # keys of the batch that the table had
    opened: int  # folders whose keys or rows were read
    skipped: int  # folders of the table that were not


class BucketedTable:
    """``buckets`` is the table's, whatever is asked for later. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        state = self._state(self._version())
        self.buckets = state["buckets"] if state else buckets

    @staticmethod
    def named(spark: SparkSession, folder: str, table: str, buckets: int = BUCKETS) -> BucketedTable:
        key, schema = TARGET_TABLES[table]
        return BucketedTable(spark, f"{folder.rstrip('/')}/{table}", key, schema, buckets)

    # --- state --------------------------------------------------------------

    def _versions(self) -> list[int]:
        found = (MANIFEST.match(n) for n in child_names(self.spark, f"{self.path}/manifests"))
        return sorted(int(m.group(1)) for m in found if m)

    def _version(self) -> int:
        return max(self._versions(), default=0)

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/m{version:09d}.json"

    def _state(self, version: int) -> dict | None:
        return json.loads(read_small(self.spark, self._manifest(version))) if version else None

    def folders(self) -> list[Folder]:
        """The current folders: at most ``FOLDERS`` a bucket and one more, whatever the table's size."""
        state = self._state(self._version())
        return [Folder(**f) for f in state["folders"]] if state else []

    def location(self, folder: Folder) -> str:
        return f"{self.path}/data/{folder.write}/{BUCKET}={folder.bucket}"

    def _commit(self, folders: list[Folder]) -> None:
        """Name the new folders, then remove what the current and the former state do without."""
        version = self._version() + 1
        state = {"buckets": self.buckets, "folders": [asdict(f) for f in folders]}
        write_small(self.spark, self._manifest(version), json.dumps(state))
        kept = {(f["write"], f["bucket"]) for v in (version, version - 1) for f in (self._state(v) or {"folders": []})["folders"]}
        writes = {w for w, _ in kept}
        for old in [v for v in self._versions() if v < version - 1]:
            for f in self._state(old)["folders"]:
                if f["write"] in writes and (f["write"], f["bucket"]) not in kept:
                    remove(self.spark, self.location(Folder(**f)))
            remove(self.spark, self._manifest(old))
        # Loads that no state names any more, and those that never came to an end.
        for part in ("data", "sketches"):
            for write in child_names(self.spark, f"{self.path}/{part}"):
                if write not in writes:
                    remove(self.spark, f"{self.path}/{part}/{write}")

    # --- reading ------------------------------------------------------------

    def read(self) -> DataFrame:
        """The current rows; no rows when the table has not been written yet."""
        return self._rows(self.folders())

    def _rows(self, folders: Iterable[Folder]) -> DataFrame:
        paths = [self.location(f) for f in folders]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _key(self) -> Column:
        """The key as it is hashed and compared: whole numbers as long, all else as text."""
        whole = isinstance(T.StructType.fromDDL(self.schema)[self.key].dataType, INTEGRAL)
        return F.col(name(self.key)).cast("bigint" if whole else "string")

    def _bucket(self) -> Column:
        return F.pmod(F.hash("_key"), F.lit(self.buckets))

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows dealt as the buckets are."""
        return df.repartition(self.buckets, self._key())

    # --- writing ------------------------------------------------------------

    def upsert(self, batch: DataFrame) -> Written:
        """Write ``batch``, one row per key and no null key, over the table.

        Matched rows take the batch's columns and keep the others. Returns numbers of keys.
        """
        return self._write(batch, overwrite=True)

    def insert_new(self, batch: DataFrame) -> Written:
        """Add the rows of ``batch``, one per key and no null key, whose key the table lacks."""
        return self._write(batch, overwrite=False)

    def _write(self, batch: DataFrame, overwrite: bool) -> Written:
        """Keys are looked for in the folders that can hold one; those found decide what is written."""
        current = self.folders()
        rows = stage(batch.withColumn("_key", self._key()).withColumn("_bucket", self._bucket()), "upsert")
        ranges = {
            r["_bucket"]: r
            for r in rows.groupBy("_bucket").agg(F.count("*").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")).collect()
        }
        total = sum(r["n"] for r in ranges.values())
        candidates = self._candidates(rows, [f for f in current if f.bucket in ranges], ranges)
        known = self._rows(candidates).select(self._key().alias("_key"))
        if candidates:
            marked = stage(rows.join(known.withColumn("_known", F.lit(True)), "_key", "left"), "marked")
            matched = {r["_bucket"]: r["n"] for r in marked.where("_known").groupBy("_bucket").agg(F.count("*").alias("n")).collect()}
        else:
            marked, matched = rows.withColumn("_known", F.lit(None).cast("boolean")), {}
        had = sum(matched.values())
        fresh = marked if overwrite else marked.where("_known is null")
        # Buckets with nothing to write are left alone.
        touched = {b for b, r in ranges.items() if overwrite or r["n"] > matched.get(b, 0)}
        rewritten = {b for b in touched if (overwrite and matched.get(b)) or sum(f.bucket == b for f in current) >= FOLDERS}
        opened = {*candidates, *(f for f in current if f.bucket in rewritten)}
        if touched:
            columns = [name(c) for c in batch.columns]
            old = self._rows([f for f in current if f.bucket in rewritten])
            joined = fresh.where(F.col("_bucket").isin([*rewritten])) if rewritten else None
            added = fresh.where(~F.col("_bucket").isin([*rewritten])) if rewritten else fresh
            out = self._typed(self._dealt(added.select(columns)))
            if joined is not None:
                both = upsert(self._dealt(old), self._dealt(joined.select(columns)), self.key)
                out = self._typed(both).unionAll(out)
            new = self._put(out)
            self._commit([f for f in current if f.bucket not in rewritten] + new)
        return Written(total - had, had if overwrite else 0, had, len(opened), len(current) - len(opened))

    def _typed(self, df: DataFrame) -> DataFrame:
        wanted = T.StructType.fromDDL(self.schema)
        return df.select(
            *[(F.col(name(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]
        )

    def _put(self, rows: DataFrame) -> list[Folder]:
        """Write rows as one folder per bucket, and tell what is in each."""
        write = uuid.uuid4().hex
        place = f"{self.path}/data/{write}"
        rows.withColumn("_key", self._key()).withColumn(BUCKET, self._bucket()).drop("_key").write.partitionBy(BUCKET).parquet(place)
        keys = self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(place).select(BUCKET, self._key().alias("_key"))
        found = keys.groupBy(BUCKET).agg(F.count("*").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")).collect()
        maps = max((-(-r["n"] * SKETCH_BITS // MAP_BITS) for r in found), default=1)
        bits = keys.select(BUCKET, F.explode(_bits(F.lit(maps))).alias("bit"))
        sketch = bits.groupBy(BUCKET, F.expr(f"bit div {MAP_BITS}").alias("map")).agg(
            F.bitmap_construct_agg(F.col("bit") % MAP_BITS).alias("bits")
        )
        sketch.write.parquet(f"{self.path}/sketches/{write}")
        return [Folder(r[BUCKET], write, r["n"], r["low"], r["high"], maps) for r in found]

    def _candidates(self, rows: DataFrame, folders: list[Folder], ranges: dict) -> list[Folder]:
        """Folders that can hold a key of the batch: by bucket, by range, then by sketch."""
        near = [f for f in folders if f.smallest <= ranges[f.bucket]["high"] and f.largest >= ranges[f.bucket]["low"]]
        writes = sorted({f.write for f in near if exists(self.spark, f"{self.path}/sketches/{f.write}")})
        if not writes:
            return near
        sketches = None
        for write in writes:
            one = self.spark.read.schema(f"{BUCKET} int, map bigint, bits binary").parquet(f"{self.path}/sketches/{write}")
            one = one.withColumn("write", F.lit(write))
            sketches = one if sketches is None else sketches.unionAll(one)
        listed = self.spark.createDataFrame(
            [(f.bucket, f.write, f.maps) for f in near if f.write in writes], "_bucket int, write string, maps int"
        )
        # One row per key, folder of its bucket and bit; the folder can hold the key if all its bits are set.
        asked = (
            rows.select("_bucket", "_key")
            .join(F.broadcast(listed), "_bucket")  # at most FOLDERS and one more a bucket
            .select("_bucket", "write", "_key", _bits(F.col("maps")).alias("bits_asked"))
            .select("_bucket", "write", "_key", F.size("bits_asked").alias("asked"), F.explode("bits_asked").alias("bit"))
            .withColumn("map", F.expr(f"bit div {MAP_BITS}"))
        )
        byte = F.expr(f"cast(bit % {MAP_BITS} div 8 as int)")
        value = F.conv(F.hex(F.substring("bits", byte + 1, F.lit(1))), 16, 10).cast("int")
        hits = (
            asked.join(sketches.withColumnRenamed(BUCKET, "_bucket"), ["_bucket", "write", "map"])
            .where(F.getbit(value, F.expr("cast(bit % 8 as int)")) == 1)
            .groupBy("_bucket", "write", "_key", "asked")
            .agg(F.count("*").alias("hits"))
            .where("hits = asked")
        )
        found = {(r["_bucket"], r["write"]) for r in hits.select("_bucket", "write").distinct().collect()}
        return [f for f in near if f.write not in writes or (f.bucket, f.write) in found]


def _bits(maps: Column) -> Column:
    """The bits a key sets in a sketch of so many bitmaps."""
    size = maps.cast("bigint") * MAP_BITS
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64("_key", F.lit(i)), size) for i in range(SKETCH_HASHES)]))
