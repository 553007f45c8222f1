"""Whole-table ranking without a single-partition window.

``RANK() OVER (ORDER BY x)`` with no PARTITION BY makes Spark move every row
into one task. ``global_rank`` instead stores the rows once, cut into ranges of
the key and sorted (``stored.py``): a row's number is its place in its range
plus the rows of the ranges before it, a table of one row for a range. Rows of
one key are ordered by a hash of the whole row, and the ranges are cut on that
too, so a hot key is spread over several ranges.

* row_number is that number;
* rank of a key is the smallest number of its rows, percent_rank follows;
* dense_rank numbers the distinct keys the same way.

The ranks are joined back to the stored rows on the key. The input is read
once, whatever the number of methods; making the plan runs the job that stores
it. NULL keys form one tie group placed last or first.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stored import numbered, store_in_order

_METHODS = ("rank", "dense_rank", "percent_rank", "row_number")


def _order(key: str, ascending: bool, nulls_last: bool):
    c = F.col(key)
    if ascending:
        return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if nulls_last else c.desc_nulls_first()


def global_rank(df: DataFrame, order_col: str, ascending: bool = True, method: str = "rank",
                out: str | None = None, nulls_last: bool | None = None,
                buckets: int | None = None, total_col: str | None = None,
                extra: dict | None = None) -> DataFrame:
    """Add column ``out`` holding the whole-table rank of ``order_col``.
    ``extra`` maps more output names to methods computed in the same pass;
    ``total_col`` (optional) receives the table's row count; ``buckets`` is the
    number of key ranges. An empty table gives an empty table."""
    methods = dict(extra or {})
    methods[out or method] = method
    if any(m not in _METHODS for m in methods.values()):
        raise ValueError(f"unknown method in {methods}")
    if nulls_last is None:
        nulls_last = not ascending          # NULL is the smallest value
    if buckets is None:
        buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    order = _order("_key", ascending, nulls_last)
    rows = df.withColumn("_key", F.col(order_col)).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    rows = numbered(store_in_order(rows, [order, F.col("_tie")], buckets), "_number")

    keys = rows.groupBy("_key").agg(F.min("_number").alias("_rank"))
    if "dense_rank" in methods.values():
        keys = numbered(store_in_order(keys, [order], buckets), "_dense").drop("_range", "_place")
    made = {"rank": F.col("_rank"), "dense_rank": F.col("_dense") if "dense_rank" in methods.values() else None,
            "row_number": F.col("_number"),
            "percent_rank": F.when(F.col("_total") > 1, (F.col("_rank") - 1) / (F.col("_total") - 1)).otherwise(0.0)}
    wanted = set(methods.values())
    if wanted & {"rank", "dense_rank", "percent_rank"}:
        rows = rows.withColumnRenamed("_key", "_own").join(keys, F.col("_own").eqNullSafe(F.col("_key")))
    if total_col or "percent_rank" in wanted:
        rows = rows.withColumn("_total", rows.agg(F.count(F.lit(1))).scalar())
    outs = [made[m].cast("double" if m == "percent_rank" else "long").alias(name) for name, m in methods.items()]
    if total_col:
        outs.append(F.col("_total").alias(total_col))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *outs)
