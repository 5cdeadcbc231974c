import json
import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

RUN_TS = datetime(2024, 6, 1, 12, 0, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from siltgate.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def documents(spark):
    """VARIANT documents from Python values, in order of pos."""

    def build(*values):
        rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "pos int, line string").select(
            "pos", F.try_parse_json("line").alias("document")
        )

    return build
