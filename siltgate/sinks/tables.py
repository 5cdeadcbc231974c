"""Target tables as versioned parquet folders.

A new state is written to a new version folder and counts once its ``_SUCCESS``
marker is there, so a failed write leaves the old state in place. The state before
it stays for those who are still reading it; older ones are removed. New rows are
appended to the current version. Reading applies the declared schema: columns
that older files lack are NULL.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.fixed_values import LOAD_TIME_COLUMN, TARGET_TABLES
from siltgate.functions.text import lit, name
from siltgate.sources.files import child_names, exists, remove

VERSION = re.compile(r"^v(\d{9})$")
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class TargetTable:
    spark: SparkSession
    path: str
    key: str
    schema: str

    @staticmethod
    def named(spark: SparkSession, folder: str, table: str) -> TargetTable:
        key, schema = TARGET_TABLES[table]
        return TargetTable(spark, f"{folder.rstrip('/')}/{table}", key, schema)

    def _versions(self) -> list[int]:
        """Versions begun, the newest first."""
        found = [VERSION.match(n) for n in child_names(self.spark, self.path)]
        return sorted((int(m.group(1)) for m in found if m), reverse=True)

    def _done(self) -> list[int]:
        return [n for n in self._versions() if exists(self.spark, f"{self._folder(n)}/_SUCCESS")]

    def _version(self) -> int:
        return next(iter(self._done()), 0)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v{version:09d}"

    def read(self) -> DataFrame:
        """The current rows; no rows when the table has not been written yet."""
        version = self._version()
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def replace(self, df: DataFrame) -> None:
        df.select(*self._typed(df)).write.parquet(self._folder(max(self._versions(), default=0) + 1))
        kept = self._done()[:KEPT_VERSIONS]
        for version in self._versions():
            if version < kept[-1]:
                remove(self.spark, self._folder(version))

    def append(self, df: DataFrame) -> None:
        version = self._version()
        if version == 0:
            self.replace(df)
        else:
            df.select(*self._typed(df)).write.mode("append").parquet(self._folder(version))

    def _typed(self, df: DataFrame) -> list:
        wanted = T.StructType.fromDDL(self.schema)
        return [
            (F.col(name(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted
        ]


def create_statement(table: str, location: str | None = None, as_name: str | None = None) -> str:
    """Spark DDL for a target as a catalog table, which fills its load time by itself.

    ``as_name`` is the table's name in the catalog, if another than the layout's.
    """
    _, schema = TARGET_TABLES[table]
    stamped = LOAD_TIME_COLUMN.get(table)
    columns = [
        f"{name(f.name)} {f.dataType.simpleString()}" + (" default current_timestamp()" if f.name == stamped else "")
        for f in T.StructType.fromDDL(schema)
    ]
    place = f" location {lit(location)}" if location else ""
    return f"create table if not exists {as_name or table} ({', '.join(columns)}) using parquet{place}"


def insert_rows(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append rows to a catalog table; columns they lack take the table's default, else NULL."""
    target = spark.table(table)
    have = [f for f in target.schema if f.name in rows.columns]
    typed = rows.select(*[F.col(name(f.name)).cast(f.dataType).alias(f.name) for f in have])
    view = f"insert_{uuid.uuid4().hex}"
    typed.createOrReplaceTempView(view)
    try:
        spark.sql(f"insert into {table} ({', '.join(name(f.name) for f in have)}) select * from {view}")
    finally:
        spark.catalog.dropTempView(view)


def missing_columns(spark: SparkSession, table: str) -> str | None:
    """DDL that adds the columns an older catalog table lacks, or None."""
    _, schema = TARGET_TABLES[table]
    have = set(spark.table(table).columns)
    lacking = [f for f in T.StructType.fromDDL(schema) if f.name not in have]
    if not lacking:
        return None
    added = ", ".join(f"{name(f.name)} {f.dataType.simpleString()}" for f in lacking)
    return f"alter table {table} add columns ({added})"


def ensure_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the catalog table if absent and add the columns it lacks."""
    spark.sql(create_statement(table, location))
    change = missing_columns(spark, table)
    if change:
        spark.sql(change)


def evolve(df: DataFrame, schema: str) -> DataFrame:
    """An older frame under a newer schema: missing columns are NULL."""
    wanted = df.sparkSession.createDataFrame([], schema)
    return wanted.unionByName(df, allowMissingColumns=True)


@dataclass(frozen=True)
class TypedRows:
    """``rows`` in the target's types, with ``fault`` naming a column that does not fit."""

    rows: DataFrame

    @property
    def good(self) -> DataFrame:
        return self.rows.filter("fault is null").drop("fault")

    @property
    def bad(self) -> DataFrame:
        return self.rows.filter("fault is not null")


def to_target(df: DataFrame, schema: str) -> TypedRows:
    """Cast to the target's types; decimals round half up, overflow is a fault."""
    wanted = {f.name: f.dataType for f in T.StructType.fromDDL(schema)}
    changing = [c for c in df.columns if c in wanted and df.schema[c].dataType != wanted[c]]
    # Cast once, below the check and the result that both use it.
    cast = df.selectExpr(
        "*", *[f"{_fitted(c, df.schema[c].dataType, wanted[c])} as {name('_to_' + c)}" for c in changing]
    )
    checks = [
        f"when {name(c)} is not null and {name('_to_' + c)} is null"
        f" then {lit(f'{c} does not fit {wanted[c].simpleString()}')}"
        for c in changing
    ]
    fault = f"case {' '.join(checks)} end" if checks else "cast(null as string)"
    columns = [f"{name('_to_' + c)} as {name(c)}" if c in changing else name(c) for c in df.columns]
    return TypedRows(cast.selectExpr(*columns, f"{fault} as fault"))


def _fitted(column: str, have: T.DataType, wanted: T.DataType) -> str:
    """SQL for a lenient cast. A double beyond a decimal's range is told by comparison, which
    is far cheaper than a cast that overflows."""
    cast = f"try_cast({name(column)} as {wanted.simpleString()})"
    if not isinstance(have, (T.DoubleType, T.FloatType)) or not isinstance(wanted, T.DecimalType):
        return cast
    whole, half = "1" + "0" * (wanted.precision - wanted.scale), "0." + "0" * wanted.scale + "5"
    return f"case when abs({name(column)}) < {whole}D - {half}D then {cast} end"
