"""Several tables published as one version."""
from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = "version long, table_name string, path string"


def _manifest(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_ENTRY).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def _latest(spark: SparkSession, root: str) -> list:
    """Manifest rows of the newest version: one a table."""
    entries = _manifest(spark, root)
    newest = entries.agg(F.max("version")).scalar()
    return entries.filter(F.col("version") == newest).collect()


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> int:
    """Writes every table under a folder of its own, then appends one file to
    the manifest that names them all; returns the version. Tables that are not
    given keep their place. Until that file is there readers see the version
    before, so a failure between tables changes nothing for them. The given
    tables may be read from the same root. One writer at a time."""
    old = _latest(spark, root)
    version = old[0].version + 1 if old else 1
    paths = {r.table_name: r.path for r in old}
    for name, df in tables.items():
        paths[name] = f"{root.rstrip('/')}/data/{name}-{uuid.uuid4().hex}"
        df.write.parquet(paths[name])
    entries = spark.createDataFrame([(version, name, path) for name, path in paths.items()], _ENTRY)
    entries.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return version


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest version; none where nothing was published."""
    return {r.table_name: spark.read.parquet(r.path) for r in _latest(spark, root)}
