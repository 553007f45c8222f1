"""Incremental staging loads with Structured Streaming.

The staging layer is append-only with a load time per row. New raw files
dropped into a landing folder are picked up exactly once (the file source
tracks processed files in the checkpoint), stamped with ``loaded_at`` and
appended to the staging Parquet table. ``availableNow`` processes whatever
has landed and stops, so the same job serves scheduled batch loads; the
checkpoint lives under the cluster's shared checkpoint folder.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.schemas import RAW_SCHEMAS


def stage_stream(spark: SparkSession, table: str, landing_dir: str, staging_dir: str,
                 fmt: str = "parquet", checkpoint: str | None = None, once: bool = True):
    """Start (and with ``once`` wait for) a stream landing -> staging."""
    schema = RAW_SCHEMAS[table]
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    src = reader.load(landing_dir)
    out = src.withColumn("loaded_at", F.current_timestamp())
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage_{table}"
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).option("path", staging_dir))
    q = q.trigger(availableNow=True) if once else q.trigger(processingTime="1 minute")
    handle = q.start()
    if once:
        handle.awaitTermination()
    return handle
