"""The three kinds of sources as extractors: what to read, given to a run instead of a batch."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import SparkSession

from siltgate.operators.responses import Paging
from siltgate.plans.run import Batch
from siltgate.sources.api import read_responses
from siltgate.sources.csv_files import CsvOptions, read_csv
from siltgate.sources.documents import land_documents


@dataclass(frozen=True)
class CsvFolder:
    """All CSV files below a folder."""

    path: str
    options: CsvOptions = field(default_factory=CsvOptions)

    def extract(self, spark: SparkSession, run_ts: datetime) -> Batch:
        scan = read_csv(spark, self.path, run_ts, self.options)
        # Rows of different files have no order of their own; in a file the later row wins.
        return Batch(scan.rows, errors=scan.errors, order="row_number", null_is_missing=True)


@dataclass(frozen=True)
class ApiLog:
    """The landed responses of an API, as parquet with the columns of a response log."""

    path: str
    paging: Paging = field(default_factory=Paging)

    def extract(self, spark: SparkSession, run_ts: datetime) -> Batch:
        scan = read_responses(spark.read.parquet(self.path), self.paging)
        return Batch(scan.records, "document", scan.errors, "record_number", error_count=scan.error_count)


@dataclass(frozen=True)
class DocumentExport:
    """A document collection exported as JSON lines."""

    path: str
    collection: str

    def extract(self, spark: SparkSession, run_ts: datetime) -> Batch:
        scan = land_documents(spark.read.text(self.path), "value", self.collection, run_ts)
        return Batch(scan.documents, "document", scan.errors, error_count=scan.error_count)
