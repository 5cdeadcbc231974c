"""Run queries and their SQL side by side: python tests/check_queries.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, function, oracle):
    frame = function(spark, sf_dir)
    mine = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if oracle is None:
        return len(mine[1]), None
    result = con.execute(oracle)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return len(mine[1]), f"columns {mine[0]} / {theirs[0]}"
    if mine[1] == theirs[1]:
        return len(mine[1]), ""
    lacking = [r for r in theirs[1] if r not in set(mine[1])][:3]
    extra = [r for r in mine[1] if r not in set(theirs[1])][:3]
    return len(mine[1]), f"{len(mine[1])} / {len(theirs[1])} rows, extra {extra}, lacking {lacking}"


def main() -> int:
    sf, wanted = (sys.argv[1:2] or ["0.01"])[0], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    import __spark_entry__ as entry

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            count, difference = compare(spark, con, sf_dir, function, oracles.get(name))
        except Exception as failure:  # report every query
            count, difference = -1, f"{type(failure).__name__}: {str(failure)[:1500]}"
        state = "rows only" if difference is None else "ok" if difference == "" else "DIFFERENT"
        bad += state == "DIFFERENT"
        print(f"{name:32} {count:8} {time.time() - start:6.2f}s {state} {difference or ''}", flush=True)
    print(f"{bad} different")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
