"""Reduced tables kept once in the shared folder.

Ranks, running sums and quantiles look at the same rows several times. They
read their input once, store the few columns they need, cut into key ranges
and sorted, and do the rest on the stored rows; a lost executor costs only the
tasks that read from it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_PLACE_BITS = 33        # of monotonically_increasing_id: partition above, place in it below


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. Runs a job."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_in_order(df: DataFrame, order: list[Column], ranges: int) -> DataFrame:
    """Store ``df`` cut into key ranges and sorted, with ``_range`` and the
    row's ``_place`` in it. One read of the input, one shuffle."""
    ranged = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    stored = store(ranged.withColumn("_id", F.monotonically_increasing_id()), "in-order")
    return stored.select(*[F.col(f"`{c}`") for c in df.columns], F.shiftright("_id", _PLACE_BITS).alias("_range"),
                         F.col("_id").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place"))


def before_range(totals: DataFrame, columns: list[str], groups: list[str] | None = None) -> DataFrame:
    """Sums of ``columns`` over the ranges before each one (within ``groups``),
    named ``_before_*``. The table has a row for a range and group, so a plain
    window does."""
    w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))
    w = w.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*(groups or []), "_range",
                         *[F.coalesce(F.sum(c).over(w), F.lit(0).cast("long")).alias(f"_before_{c}") for c in columns])


def numbered(stored: DataFrame, out: str) -> DataFrame:
    """Give rows of ``store_in_order`` their numbers 1..n in the stored order.
    The offsets have one row for a range and are broadcast."""
    counts = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
    return (stored.join(F.broadcast(before_range(counts, ["rows"])), "_range")
            .withColumn(out, F.col("_before_rows") + F.col("_place") + 1).drop("_before_rows"))
