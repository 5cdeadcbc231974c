"""Pieces several operators of this package share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# monotonically_increasing_id keeps the row's index inside its partition in these bits.
ROW_BITS = 33


def n_words(text: str) -> Column:
    """Number of words of a text column; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder named by spark.checkpoint.dir and read it back.

    The files are shared by all executors, so a lost executor costs nothing that was staged.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = "/tmp/siltgate-checkpoints"  # one machine, as in tests
    return folder.rstrip("/")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_held: dict[Any, Any] = {}


def held_in_worker(key: Any, make: Callable[[], Any]) -> Any:
    """What an operator keeps in a worker process from task to task, such as look-ups it has made.

    Workers serve one operator after another, so only the last one's is held: caches of several
    operators never add up in an executor's memory.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]
