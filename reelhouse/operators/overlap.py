"""Interval-overlap counting by month.

"Active in month m" for a row with [start, end] (end NULL = open) means
start <= last day of m and (end >= first day of m or end is NULL), i.e.
month(start) <= m <= month(end). Instead of a nested-loop range join (rows x
months) the count is a running sum of +1/-1 deltas: +1 at month(start), -1 at
month(end)+1. Rows are reduced to one delta row per month by a hash
aggregate, so the only window runs over the month axis (bounded by the
calendar span, not by the data). Rows whose end month precedes their start
month are active nowhere and add no delta.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_index


def _mi_to_label(mi):
    year = F.floor((mi - 1) / 12).cast("int")
    month = (mi - year * 12).cast("int")
    return F.date_format(F.make_date(year, month, F.lit(1)), "yyyy-MM")


def active_by_month(rows: DataFrame, start_col: str, end_col: str, months: DataFrame,
                    measures: dict) -> DataFrame:
    """For each month label in ``months`` (column ``ym``), sum each measure over
    rows active in that month. ``measures`` maps output name -> Column
    evaluated per row (use ``F.lit(1)`` to count rows)."""
    s_mi = month_index(F.col(start_col))
    e_mi = month_index(F.col(end_col))
    live = rows.filter(F.col(end_col).isNull() | (e_mi >= s_mi))
    plus = live.select(s_mi.alias("mi"), *[c.alias(n) for n, c in measures.items()])
    minus = live.filter(F.col(end_col).isNotNull()).select(
        (e_mi + 1).alias("mi"), *[(-c).alias(n) for n, c in measures.items()])
    target = months.select(
        (F.substring("ym", 1, 4).cast("int") * 12 + F.substring("ym", 6, 2).cast("int")).alias("mi"),
        *[F.lit(0).cast(plus.schema[n].dataType).alias(n) for n in measures])
    deltas = plus.unionByName(minus).unionByName(target) \
        .groupBy("mi").agg(*[F.sum(n).alias(n) for n in measures])
    w = Window.orderBy("mi").rowsBetween(Window.unboundedPreceding, 0)
    running = deltas.select("mi", *[F.sum(n).over(w).alias(n) for n in measures])
    return running.join(target.select("mi"), "mi").select(
        _mi_to_label(F.col("mi")).alias("ym"), *measures)


def active_by_month_explode(rows: DataFrame, start_col: str, end_col: str, months: DataFrame,
                            measures: dict, first_ym: str, last_ym: str) -> DataFrame:
    """Cross-check form: explode each row's month sequence clipped to the
    window [first_ym, last_ym], then aggregate (used in tests)."""
    lo = F.to_date(F.lit(first_ym + "-01"))
    hi = F.to_date(F.lit(last_ym + "-01"))
    s = F.greatest(F.trunc(F.col(start_col), "month"), lo)
    e = F.least(F.coalesce(F.trunc(F.col(end_col), "month"), hi), hi)
    ex = rows.filter(s <= e).select(
        F.explode(F.sequence(s, e, F.expr("interval 1 month"))).alias("m"),
        *[c.alias(n) for n, c in measures.items()])
    agg = ex.groupBy(F.date_format("m", "yyyy-MM").alias("ym")).agg(
        *[F.sum(n).alias(n) for n in measures])
    return months.select("ym").join(agg, "ym", "left").fillna(0)
