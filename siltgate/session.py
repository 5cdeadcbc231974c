"""Session helpers: the shared scratch folder and staged tables.

A staged table cuts a plan: what several steps read is computed once and, being
in shared storage, survives the loss of executors.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folder: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the library is tuned for.

    Rule sets make long projections. Above 8000 bytes of bytecode the JVM does not
    compile a method, so whole-stage code of that size runs interpreted; below the
    limit set here Spark fuses operators, above it each projection is compiled in
    small methods of its own.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or on one machine the one given to use_folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    one_machine = re.match(r"local(\[|$)", spark.sparkContext.master)
    if not one_machine or _local_folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder


def use_folder(path: str) -> None:
    """The folder for staged tables of a local master whose spark.checkpoint.dir is unset."""
    global _local_folder
    _local_folder = path.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_staged_by(spark)}/{label}-{uuid.uuid4().hex}"


def _staged_by(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/siltgate/{spark.sparkContext.applicationId}"


def remove_staged(spark: SparkSession) -> None:
    """Remove all this application has staged, once nothing that reads it is needed any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staged_by(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A staged table of at most this many bytes of parquet is sent to every task.
BROADCAST_BYTES = 4 << 20


def broadcast_if_small(staged: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast when the size of its files allows it.

    Decided before the join: the larger side is then never shuffled, which a
    switch at run time would come too late for. The size comes from the file
    listing, so no job runs.
    """
    size = staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(staged) if int(str(size)) <= limit else staged


def counted(df: DataFrame, label: str, **metrics: str) -> DataFrame:
    """Report row counts to query listeners as the rows pass.

    The node also stops filters on costly columns from being pushed below the
    expressions they are made of, which would compute those once more.
    """
    return df.observe(
        f"{label} {uuid.uuid4().hex}", *[F.expr(e).alias(n) for n, e in metrics.items()]
    )
