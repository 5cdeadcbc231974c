"""All derived inputs at once, for those who time queries and not their inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from workloads.inputs import API_LOG, DOCUMENTS, LANDED, PRODUCTS, USERS, land
from workloads.runs import extractors


def land_all(spark: SparkSession, sf_dir: str) -> None:
    land(spark, sf_dir, "users", USERS, "customer", "nation")
    land(spark, sf_dir, "documents", DOCUMENTS, "customer", "nation")
    land(spark, sf_dir, "products", PRODUCTS, "part")
    land(spark, sf_dir, "pages", LANDED, "part")
    land(spark, sf_dir, "api-log", API_LOG, "part")
    extractors(spark, sf_dir)
