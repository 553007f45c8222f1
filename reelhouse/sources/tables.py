"""Parquet readers for the driver's test tables.

Every read names its columns, so the scan's ReadSchema carries only what the
plan needs; filters written on top are pushed into the Parquet reader.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
