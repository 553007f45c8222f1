"""Top-k per key."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_key(df: DataFrame, key, order_cols, k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each key under ``order_cols`` (a full,
    tie-free order), numbering them 1..k. Spark plans this as a window group
    limit: each task keeps only k rows per key before the final ranking."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
