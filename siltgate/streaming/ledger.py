"""Streams loaded once per batch, with a high-water mark per source.

A ledger keeps one entry per micro-batch: each source's mark after it, its rows, and how many of
them came late, at or below the mark the batch began with. An entry is written when the batch has
been loaded. A batch that comes again is left alone if it has an entry; if it failed before, it
starts from the same marks as the first time, so the same rows are late.

The marks live beside the target instead of in keyed stream state: a batch needs only each source's
largest id, a partial aggregate, so a source with most of the rows is not one task's work.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltgate.functions.text import name
from siltgate.operators.incremental import advanced, keep_new_by_source, next_checkpoint
from siltgate.sources.delivery import deliver
from siltgate.sources.files import child_names, read_small, write_small

ENTRY = re.compile(r"^b(\d{12})\.json$")
MARKS = "source_name string, last_processed_id string"


@dataclass(frozen=True)
class Entry:
    """``marks`` by source; ``rows`` and ``late`` by source, of this batch alone."""

    batch: int
    marks: dict[str, str]
    rows: dict[str, int]
    late: dict[str, int]


@dataclass(frozen=True)
class Ledger:
    """One per stream; an entry is as large as the number of sources."""

    spark: SparkSession
    path: str

    def batches(self) -> list[int]:
        found = (ENTRY.match(n) for n in child_names(self.spark, self.path))
        return sorted(int(m.group(1)) for m in found if m)

    def entry(self, batch: int) -> Entry:
        return Entry(**json.loads(read_small(self.spark, self._file(batch))))

    def entries(self) -> list[Entry]:
        return [self.entry(b) for b in self.batches()]

    def marks_before(self, batch: int) -> dict[str, str]:
        earlier = [b for b in self.batches() if b < batch]
        return self.entry(earlier[-1]).marks if earlier else {}

    def write(self, entry: Entry) -> None:
        write_small(self.spark, self._file(entry.batch), json.dumps(entry.__dict__))

    def _file(self, batch: int) -> str:
        return f"{self.path.rstrip('/')}/b{batch:012d}.json"


def take_batch(
    rows: DataFrame,
    batch: int,
    ledger: Ledger,
    load: Callable[[DataFrame, int], object],
    id_column: str = "id",
    source_column: str = "source_name",
) -> Entry:
    """Load the rows of one micro-batch that are past their source's mark, and enter it.

    Rows without an id or a mark to compare with are never late. ``load`` gets the others, staged,
    and must bear being called again for a batch that failed, as a keyed load does.
    """
    if batch in ledger.batches():
        return ledger.entry(batch)
    spark = rows.sparkSession
    before = ledger.marks_before(batch)
    marks = spark.createDataFrame(list(before.items()), MARKS)
    # One pass over the batch: what is new and what is late land side by side.
    narrow = rows.select(F.struct("*").alias("silt_row"), name(id_column), name(source_column))
    marked = keep_new_by_source(narrow, marks, id_column, source_column, mark="silt_new")
    landed = deliver(marked.select("silt_row.*", "silt_new"), "not silt_new", "stream")
    new, late = landed.records.drop("silt_new"), landed.errors.drop("silt_new")
    if landed.record_count:
        load(new, batch)
    found = next_checkpoint(new, id_column, by=source_column).toDF("source", "found")
    merged = found.join(marks.toDF("source", "former"), "source", "left").select(
        "source", F.expr(advanced("former", "found")).alias("mark")
    )
    after = before | {r["source"]: r["mark"] for r in merged.collect() if r["source"] is not None and r["mark"] is not None}

    def by_source(frame: DataFrame) -> dict[str, int]:
        return {str(r["source"]): r["n"] for r in frame.groupBy(F.col(name(source_column)).alias("source")).agg(F.count("*").alias("n")).collect()}

    n_new, n_late = by_source(new), by_source(late)
    total = {s: n_new.get(s, 0) + n_late.get(s, 0) for s in sorted({*n_new, *n_late})}
    entry = Entry(batch, after, total, {s: n_late.get(s, 0) for s in total})
    ledger.write(entry)
    return entry


def load_stream(
    stream: DataFrame,
    ledger: Ledger,
    load: Callable[[DataFrame, int], object],
    checkpoint: str,
    id_column: str = "id",
    source_column: str = "source_name",
) -> StreamingQuery:
    """Take what has landed since the last time, batch by batch, then stop; start it again for more."""

    def run(rows: DataFrame, batch: int) -> None:
        take_batch(rows, batch, ledger, load, id_column, source_column)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
