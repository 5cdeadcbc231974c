"""Load a relational target: write a staging table in parallel, then merge it in one statement.

Row-by-row statements do not scale; here the executors fill a staging table over
JDBC and a single set-based statement upserts it inside the database.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f'"{n}"' for n in names)


def postgres_upsert(table: str, staging: str, columns: Sequence[str], key: str) -> str:
    """``INSERT ... ON CONFLICT``: the staged columns overwrite those of a matched row."""
    rest = [c for c in columns if c != key]
    updates = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in rest)
    action = f"DO UPDATE SET {updates}" if rest else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({_quoted(columns)}) SELECT {_quoted(columns)} FROM {staging}"
        f' ON CONFLICT ("{key}") {action}'
    )


def merge_upsert(table: str, staging: str, columns: Sequence[str], key: str) -> str:
    """Standard ``MERGE``, also for catalogs whose tables take row-level changes."""
    rest = [c for c in columns if c != key]
    updates = ", ".join(f't."{c}" = s."{c}"' for c in rest)
    values = ", ".join(f's."{c}"' for c in columns)
    matched = f" WHEN MATCHED THEN UPDATE SET {updates}" if rest else ""
    return (
        f'MERGE INTO {table} t USING {staging} s ON t."{key}" = s."{key}"{matched}'
        f" WHEN NOT MATCHED THEN INSERT ({_quoted(columns)}) VALUES ({values})"
    )


def write_staging(df: DataFrame, url: str, staging: str, properties: dict[str, str]) -> None:
    """Replace the staging table. ``numPartitions`` in properties bounds the connections."""
    df.write.jdbc(url, staging, mode="overwrite", properties=properties)


def run_statement(spark: SparkSession, url: str, statement: str, properties: dict[str, str]) -> int:
    """Run one statement in one transaction and return the rows it changed."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for k, value in properties.items():
        settings.setProperty(k, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        changed = connection.createStatement().executeUpdate(statement)
        connection.commit()
        return changed
    finally:
        connection.close()


def load_postgres(
    df: DataFrame, url: str, table: str, key: str, properties: dict[str, str]
) -> int:
    """Upsert ``df`` (one row per key) into a PostgreSQL table."""
    staging = f"{table}_staging"
    write_staging(df, url, staging, properties)
    statement = postgres_upsert(table, staging, df.columns, key)
    return run_statement(df.sparkSession, url, statement, properties)
