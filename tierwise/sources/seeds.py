"""Seed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and declared types; an empty field is NULL, a bad one fails the read."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.csv(path)
