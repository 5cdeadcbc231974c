"""Run a source on files as they land: each micro-batch goes through the batch functions.

The stream's own checkpoint remembers files; the source's checkpoint table still
filters ids, so a file delivered twice loads nothing the second time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltgate.plans.run import Batch, RunResult, Source, run_source
from siltgate.sources.documents import documents_from


def load_landed_documents(
    spark: SparkSession,
    folder: str,
    source: Source,
    target_folder: str,
    checkpoint: str,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    on_result: Callable[[int, RunResult], None] | None = None,
    **options,
) -> StreamingQuery:
    """Load the JSON-lines files not seen yet, then stop; start it again for more."""

    def run(lines: DataFrame, batch_id: int) -> None:
        now = clock()
        scan = documents_from(lines, "value", source.name, now)
        batch = Batch(scan.documents, "document", scan.errors)
        result = run_source(lines.sparkSession, batch, source, target_folder, now, **options)
        if on_result:
            on_result(batch_id, result)

    return (
        spark.readStream.text(folder)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
