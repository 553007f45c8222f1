"""Exploratory aggregates and the daily series behind the notebook's
charts (the data only, no plotting)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import group_quantiles
from ..operators.stored import store
from .warehouse import Warehouse

RISKS = ["low", "medium", "high", "churned"]
CORR_FEATURES = ["total_watch_events", "total_watch_minutes", "total_completed", "total_abandoned",
                 "completion_rate", "distinct_content_watched", "distinct_days_active",
                 "avg_daily_watch_min", "days_since_last_watch"]
PIVOT_ITEMS = 10


def sql_to_frame(wh: Warehouse) -> DataFrame:
    """SQL text to DataFrame over a registered view (the DAU extract)."""
    wh.v_daily_active_users.createOrReplaceTempView("v_daily_active_users")
    return wh.spark.sql("""
        SELECT full_date, daily_active_users, total_watch_minutes
        FROM v_daily_active_users WHERE daily_active_users > 0 ORDER BY full_date""")


def value_counts(wh: Warehouse) -> DataFrame:
    """Users per churn risk and share of all users."""
    c = wh.mart_user_engagement.groupBy("churn_risk").agg(F.count(F.lit(1)).alias("users"))
    # the total comes from the few category rows, not from a second pass
    return c.withColumn("share", F.col("users") / F.sum("users").over(Window.partitionBy()))


def catalog_genre_share(wh: Warehouse) -> DataFrame:
    c = wh.dim_content.groupBy("genre").agg(F.count(F.lit(1)).alias("titles"))
    return c.withColumn("share", F.col("titles") / F.sum("titles").over(Window.partitionBy()))


def watch_quartiles_by_risk(wh: Warehouse) -> DataFrame:
    """Box-plot numbers of total minutes per churn risk: exact quartiles
    (linear interpolation) and 1.5 IQR whiskers."""
    m = store(wh.mart_user_engagement.filter(F.col("churn_risk").isin(*RISKS))
              .select("churn_risk", F.col("total_watch_minutes").cast("double").alias("x")), "risk-minutes")
    q = group_quantiles(m, ["churn_risk"], "x", [0.25, 0.5, 0.75])
    q = q.withColumn("iqr", F.col("q75") - F.col("q25"))
    j = m.join(q, "churn_risk")
    lo_fence = F.col("q25") - F.lit(1.5) * F.col("iqr")
    hi_fence = F.col("q75") + F.lit(1.5) * F.col("iqr")
    w = j.groupBy("churn_risk", "q25", "q50", "q75", "iqr").agg(
        F.count(F.lit(1)).alias("users"),
        F.min(F.when(F.col("x") >= lo_fence, F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("x") <= hi_fence, F.col("x"))).alias("whisker_high"),
        F.count_if((F.col("x") < lo_fence) | (F.col("x") > hi_fence)).alias("outliers"))
    return w.select("churn_risk", "users", *[F.round(c, 4).alias(c) for c in
                                             ["q25", "q50", "q75", "iqr", "whisker_low", "whisker_high"]],
                    "outliers")


def feature_correlation(wh: Warehouse) -> DataFrame:
    """Pearson correlation of each feature pair (pairwise non-null rows),
    one aggregate pass."""
    m = wh.mart_user_engagement.select(*[F.col(c).cast("double").alias(c) for c in CORR_FEATURES])
    pairs = [(a, b) for i, a in enumerate(CORR_FEATURES) for b in CORR_FEATURES[i + 1:]]
    wide = m.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in pairs)
    long = wide.select(F.expr(f"stack({len(pairs)}, {stack}) AS (feature_a, feature_b, corr)"))
    return long.withColumn("corr", F.round("corr", 6))


def interactions(wh: Warehouse) -> DataFrame:
    """User-title interactions: views, completions, minutes (1 decimal)."""
    return wh.pairs.select("user_id", "content_id", F.col("n_events").alias("view_count"),
                           "completions", F.round("minutes", 1).alias("total_minutes"))


def interactions_binary(wh: Warehouse) -> DataFrame:
    """Watched = total minutes above zero after rounding to one decimal."""
    return interactions(wh).filter(F.col("total_minutes") > 0).select("user_id", "content_id")


def interaction_sparsity(wh: Warehouse) -> DataFrame:
    i = interactions(wh)
    return i.agg(F.countDistinct("user_id").alias("n_users"),
                 F.countDistinct("content_id").alias("n_items"),
                 F.count_if(F.col("total_minutes") > 0).alias("nonzero")) \
        .withColumn("sparsity", (F.col("n_users") * F.col("n_items") - F.col("nonzero"))
                    / (F.col("n_users") * F.col("n_items")))


def interaction_pivot_topk(wh: Warehouse, k: int = PIVOT_ITEMS) -> DataFrame:
    """User x item minutes for the k most viewed titles only (a bounded
    pivot; the full matrix stays in long form). Columns item_1..item_k."""
    order = [F.col("total_views").desc(), F.col("content_id")]
    top = wh.content_stats.select("content_id", "total_views").orderBy(*order).limit(k)
    top = top.withColumn("item_rank", F.row_number().over(Window.orderBy(*order)))      # k rows
    i = interactions(wh).join(F.broadcast(top.select("content_id", "item_rank")), "content_id", "left")
    return i.groupBy("user_id").agg(*[
        F.coalesce(F.max(F.when(F.col("item_rank") == r, F.col("total_minutes"))), F.lit(0))
        .cast("double").alias(f"item_{r}") for r in range(1, k + 1)])


# ---- daily series ------------------------------------------------------------
def dau_series(wh: Warehouse) -> DataFrame:
    """Days with activity, gap-filled with 0 from the first to the last."""
    d = wh.v_daily_active_users.filter(F.col("daily_active_users") > 0) \
        .select("full_date", "daily_active_users")
    lo = d.agg(F.min("full_date")).scalar()
    hi = d.agg(F.max("full_date")).scalar()
    cal = wh.spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias("full_date"))
    return cal.join(d, "full_date", "left").select(
        "full_date", F.coalesce("daily_active_users", F.lit(0)).cast("bigint").alias("dau"))


def dau_summary(wh: Warehouse) -> DataFrame:
    s = dau_series(wh)
    return s.agg(F.count(F.lit(1)).alias("days"), F.round(F.avg("dau"), 6).alias("mean_dau"),
                 F.round(F.stddev_samp("dau"), 6).alias("std_dau"),
                 F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))


def dau_rolling_strict(wh: Warehouse) -> DataFrame:
    """30-row mean, NULL until 30 rows are present (series is per day)."""
    s = dau_series(wh)
    w = Window.orderBy("full_date").rowsBetween(-29, 0)
    return s.select("full_date", "dau", F.when(F.count(F.lit(1)).over(w) == 30,
                                               F.round(F.avg("dau").over(w), 6)).alias("dau_30d_mean"))


def dau_holdout(wh: Warehouse, horizon: int = 30) -> DataFrame:
    """Train/test cut: the last ``horizon`` days are the test part."""
    s = dau_series(wh)
    last = s.agg(F.max("full_date")).scalar()
    return s.withColumn("part", F.when(F.col("full_date") > F.date_sub(last, horizon), "test")
                        .otherwise("train"))
