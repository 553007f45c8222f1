"""Ordered prefix sums and exact group quantiles without single-task windows.

``ordered_prefix_sums`` gives, per distinct (partition..., key), the summed
weights and their running totals in key order. The distinct keys with their
sums are stored once, cut into ranges of (partition..., key) and sorted
(``stored.py``); windows run per (partition, range), and the sums of the ranges
before supply the offsets. A hot key is one aggregated row, so skew does not
reach the windows. The input is read once, by the job that stores the sums.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stored import before_range, store_in_order


def ordered_prefix_sums(df: DataFrame, key: str, weights: list[str], partition_cols=(),
                        ascending: bool = True, buckets: int | None = None) -> DataFrame:
    parts = list(partition_cols)
    if buckets is None:
        buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    order = F.col(key).asc() if ascending else F.col(key).desc()
    agg = df.filter(F.col(key).isNotNull()).groupBy(*parts, key).agg(*[F.sum(w).alias(w) for w in weights])
    rows = store_in_order(agg, [*[F.col(c) for c in parts], order], buckets)
    totals = before_range(rows.groupBy(*parts, "_range").agg(*[F.sum(w).alias(w) for w in weights]), weights, parts)
    totals = totals.select(*[F.col(c).alias("_g_" + c) for c in parts], F.col("_range").alias("_g_range"),
                           *[f"_before_{w}" for w in weights])
    within = Window.partitionBy(*parts, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    # a NULL group is a group
    joined = rows.join(totals, [F.col(c).eqNullSafe(F.col("_g_" + c)) for c in parts] + [F.col("_range") == F.col("_g_range")])
    return joined.select(*parts, key, *weights,
                         *[(F.col(f"_before_{w}") + F.sum(w).over(within)).alias("cum_" + w) for w in weights])


def group_quantiles(df: DataFrame, group_cols, value: str, probs, prefix: str = "q") -> DataFrame:
    """Exact quantiles with linear interpolation (lo + (hi - lo) * frac at
    position p * (n - 1)), per group, one column per probability.

    Each distinct value covers a run of positions; a group's quantile takes the
    values whose runs hold the positions below and above. That is one aggregate
    over the running counts joined to the groups' sizes."""
    groups = list(group_cols)
    d = df.select(*groups, F.col(value).cast("double").alias("_v"), F.lit(1).cast("bigint").alias("_one"))
    runs = ordered_prefix_sums(d, "_v", ["_one"], groups)
    sizes = runs.groupBy(*groups).agg(F.max("cum__one").alias("_n")).select(
        *[F.col(c).alias("_s_" + c) for c in groups], "_n")
    if groups:
        runs = runs.join(sizes, [F.col(c).eqNullSafe(F.col("_s_" + c)) for c in groups])
    else:
        runs = runs.withColumn("_n", sizes.agg(F.max("_n")).scalar())
    holds = lambda place: (F.col("cum__one") - F.col("_one") <= place) & (place < F.col("cum__one"))
    low, outs = {}, []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        first = F.floor(at)
        low[i] = [F.max(F.when(holds(first), F.col("_v"))).alias(f"_lo{i}"),
                  F.max(F.when(holds(F.least(first + 1, F.col("_n") - 1)), F.col("_v"))).alias(f"_hi{i}"),
                  F.max(at - first).alias(f"_frac{i}")]
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_frac{i}"))
                    .alias(f"{prefix}{int(round(p * 100))}"))
    return runs.groupBy(*groups).agg(*[c for i in low for c in low[i]]).select(*groups, *outs)
