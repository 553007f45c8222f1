"""The seven analysis queries (Q1..Q7) and the warehouse's check queries.

Each function takes a ``Warehouse`` and returns a lazy DataFrame whose
columns carry the names of the SQL outputs.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dec, field_position, money_label, mysql_avg, mysql_div, ym_label
from ..functions.calendar import months_between_starts
from ..operators.rank import global_rank
from ..operators.stored import store
from .warehouse import Warehouse, completion_rate

RISK_ORDER = ["churned", "high", "medium", "low"]
PERIOD_ORDER = ["morning", "afternoon", "evening", "night"]


def q1_dau_rolling(wh: Warehouse, days: int = 30) -> DataFrame:
    """Daily active users with 7/30-row rolling means, latest ``days`` days.
    The window runs over one row per day (after aggregation)."""
    daily = wh.daily_fact.select(
        F.col("event_date"), F.col("dau"), F.round(F.col("minutes"), 0).alias("total_minutes"))
    w = Window.orderBy("event_date")
    return daily.select(
        "event_date", "dau", "total_minutes",
        F.round(F.avg(F.col("dau").cast("decimal(20,0)")).over(w.rowsBetween(-6, 0)), 1).alias("dau_7d_avg"),
        F.round(F.avg(F.col("dau").cast("decimal(20,0)")).over(w.rowsBetween(-29, 0)), 1).alias("dau_30d_avg"),
        F.round(F.sum("total_minutes").over(w.rowsBetween(-6, 0)), 0).alias("minutes_7d_sum"),
    ).orderBy(F.col("event_date").desc()).limit(days)


def user_activity(wh: Warehouse) -> DataFrame:
    """Per known user: last active day, days inactive, events, minutes,
    titles, completions (events of users missing from dim_users dropped)."""
    ud = wh.user_days.groupBy("user_id").agg(
        F.max("event_date").alias("last_active"),
        F.sum("n_events").alias("total_events"),
        F.round(F.sum("minutes"), 1).alias("total_minutes"),
        F.sum("completions").alias("completions"))
    titles = wh.pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("unique_titles"))
    # stored at a row a user: joins and ranks after it share no task with the aggregates of the events
    users = store(ud.join(titles, "user_id"), "activity")
    known = wh.deduplicated_users.select("user_id")         # the ids of dim_users
    return users.join(known, "user_id", "left_semi").withColumn(
        "days_inactive", F.datediff(wh.as_of, F.col("last_active")))


def risk_level_of(days):
    return (F.when(days <= 14, "low").when(days <= 30, "medium").when(days <= 60, "high")
            .otherwise("churned"))


def q2_churn_segments(wh: Warehouse) -> DataFrame:
    ua = user_activity(wh)
    seg = ua.join(wh.dim_users.select("user_id", "region", "age_group", "current_plan_type"), "user_id")
    seg = seg.withColumn("risk_level", risk_level_of(F.col("days_inactive")))
    # PERCENT_RANK over all users ordered by minutes (desc): whole-table rank
    # without a single-partition window. The mean of (rank-1)/(N-1) is taken
    # exactly as sum(rank-1) / (count * (N-1)).
    seg = global_rank(seg, "total_minutes", ascending=False, method="rank", out="_rk",
                      total_col="_n_all")
    agg = seg.groupBy("risk_level", "region").agg(
        F.count(F.lit(1)).alias("users"),
        F.round(mysql_avg("days_inactive"), 0).alias("avg_days_inactive"),
        F.round(mysql_avg("total_minutes", 1), 0).alias("avg_watch_min"),
        F.round(mysql_avg("unique_titles"), 0).alias("avg_titles_watched"),
        F.sum(F.col("_rk") - 1).alias("_rsum"), F.max("_n_all").alias("_nall"),
        F.sum(F.when(F.col("current_plan_type") == "premium", 1).otherwise(0)).alias("premium_users"))
    pct = F.when(F.col("_nall") > 1, F.round(
        F.col("_rsum").cast("decimal(30,0)") * dec("100") /
        (F.col("users") * (F.col("_nall") - 1)).cast("decimal(30,0)"), 1)).otherwise(dec("0.0"))
    return agg.select("risk_level", "region", "users", "avg_days_inactive", "avg_watch_min",
                      "avg_titles_watched", pct.cast("decimal(10,1)").alias("avg_engagement_pctile"),
                      "premium_users") \
        .orderBy(field_position("risk_level", RISK_ORDER), F.col("users").desc())


def q3_completion_by_genre(wh: Warehouse, min_views: int = 50) -> DataFrame:
    """Aggregated per title first, then joined to the catalogue."""
    cs = wh.content_stats.join(wh.dim_content.select("content_id", "genre", "content_type",
                                                      "duration_minutes"), "content_id")
    g = cs.groupBy("genre", "content_type").agg(
        F.sum("total_views").alias("total_views"),
        F.sum("total_completions").alias("completions"),
        F.sum("total_abandons").alias("abandons"),
        F.sum("minutes").alias("_min"),
        F.sum(F.col("total_views") * F.col("duration_minutes")).alias("_dur"))
    avg_min = mysql_div(F.col("_min"), F.col("total_views"), 2)        # AVG(decimal(8,2))
    avg_dur = mysql_div(F.col("_dur"), F.col("total_views"), 0)        # AVG(int)
    return g.filter(F.col("total_views") >= min_views).select(
        "genre", "content_type", "total_views", "completions", "abandons",
        F.round(mysql_div(F.col("completions") * dec("100.0"),
                          F.col("completions") + F.col("abandons"), 1), 1).alias("completion_pct"),
        F.round(avg_min, 1).alias("avg_watch_min"),
        F.round(mysql_div(avg_min, avg_dur, 6) * 100, 1).alias("stickiness_pct"),
    ).orderBy(F.col("completion_pct").desc_nulls_last(), "genre", "content_type")


def q4_ltv_by_plan(wh: Warehouse) -> DataFrame:
    fs = wh.fact_subscriptions.filter(F.col("plan_type") != "free_trial")
    days = F.when(F.col("end_date").isNotNull(), F.datediff("end_date", "start_date")) \
        .otherwise(F.datediff(wh.as_of, F.col("start_date")))
    sub = fs.select("user_id", "plan_type", "plan_rank", "monthly_price", "status",
                    days.alias("active_days"))
    sub = sub.withColumn("ltv", F.round(mysql_div(F.col("monthly_price") * F.col("active_days"),
                                                  dec("30.44"), 2), 2))
    per_user = sub.groupBy("user_id").agg(F.sum("ltv").alias("total_ltv"))
    j = sub.join(per_user, "user_id")
    # distinct subscribers per plan: reduce to (plan, user) first.
    subscribers = sub.select("plan_type", "user_id").distinct().groupBy("plan_type") \
        .agg(F.count(F.lit(1)).alias("subscribers"))
    a = j.groupBy("plan_type").agg(
        F.round(mysql_avg("active_days"), 0).alias("avg_sub_days"),
        F.round(mysql_avg("ltv", 2), 2).alias("avg_ltv_per_sub"),
        F.round(mysql_avg("total_ltv", 2), 2).alias("avg_total_ltv_per_user"),
        F.round(F.sum("ltv"), 2).alias("total_revenue"),
        F.sum(F.when(F.col("status") == "active", 1).otherwise(0)).alias("still_active"),
        F.count(F.lit(1)).alias("_n"))
    a = a.join(subscribers, "plan_type")
    return a.select(
        "plan_type", "subscribers", "avg_sub_days", "avg_ltv_per_sub", "avg_total_ltv_per_user",
        "total_revenue",
        F.round(mysql_div(F.col("total_revenue"), F.col("subscribers"), 2), 2).alias("revenue_per_subscriber"),
        "still_active",
        F.round(mysql_div(F.col("still_active") * dec("100.0"), F.col("_n"), 1), 1).alias("retention_pct"),
    ).orderBy(F.col("avg_total_ltv_per_user").desc())


def q5_period_device_crosstab(wh: Warehouse) -> DataFrame:
    f = wh.fve
    dev = F.col("device_type")
    g = f.groupBy("day_period").agg(
        *[F.sum(F.when(dev == d, 1).otherwise(0)).alias(d)
          for d in ["smart_tv", "mobile", "tablet", "desktop", "console"]],
        F.count(F.lit(1)).alias("total"),
        F.round(mysql_avg("watch_duration_minutes", 2), 1).alias("avg_min"),
        F.sum(F.col("is_completed").cast("int")).alias("_c"),
        F.sum(F.col("is_abandoned").cast("int")).alias("_a"))
    return g.select("day_period", "smart_tv", "mobile", "tablet", "desktop", "console", "total",
                    "avg_min", F.round(mysql_div(F.col("_c") * dec("100.0"), F.col("_c") + F.col("_a"), 1), 1)
                    .alias("completion_pct")) \
        .orderBy(field_position("day_period", PERIOD_ORDER))


def q6_cohort_retention(wh: Warehouse, first: str = "2023-01", last: str = "2025-06") -> DataFrame:
    du = wh.dim_users.select("user_id", ym_label("signup_date").alias("cohort_month"))
    sizes = du.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    active = wh.user_days.select("user_id", ym_label("event_date").alias("active_month")).distinct()
    ca = active.join(du, "user_id").withColumn(
        "months_since_signup", months_between_starts(
            F.to_date(F.concat(F.col("cohort_month"), F.lit("-01"))),
            F.to_date(F.concat(F.col("active_month"), F.lit("-01")))))
    ca = ca.filter(F.col("cohort_month").between(first, last))
    # (user, month) is distinct, so each flag sum is a distinct-user count.
    m = ca.groupBy("cohort_month").agg(*[
        F.sum(F.when(F.col("months_since_signup") == k, 1).otherwise(0)).alias(f"m{k}")
        for k in range(7)])
    j = m.join(sizes, "cohort_month")
    return j.select("cohort_month", "cohort_size", *[f"m{k}" for k in range(7)],
                    F.round(mysql_div(F.col("m3") * dec("100.0"), F.col("cohort_size"), 1), 1)
                    .alias("retention_m3_pct")).orderBy("cohort_month")


def content_roi(wh: Warehouse, min_views: int = 10) -> DataFrame:
    dc = wh.dim_content.filter(F.col("is_original"))
    j = dc.join(wh.content_stats, "content_id")
    cost_m = mysql_div(F.col("production_cost_usd"), F.lit(1000000), 2)
    return j.filter(F.col("total_views") >= min_views).select(
        "content_id", "title", "content_type", "genre", "duration_bucket", "production_cost_usd",
        "cost_tier", "total_views", "unique_viewers", F.col("total_completions").alias("completions"),
        F.round(F.col("minutes"), 0).alias("total_watch_min"),
        F.round(mysql_div(F.col("minutes"), F.col("total_views"), 2), 1).alias("avg_watch_min"),
        F.round(mysql_div(F.col("total_views"), cost_m, 0), 1).alias("views_per_million"),
        F.round(mysql_div(F.col("minutes"), cost_m, 2), 0).alias("minutes_per_million"),
        completion_rate(F.col("total_completions"), F.col("total_abandons"), 1).alias("completion_pct"))


def q7_original_roi(wh: Warehouse, top: int = 20) -> DataFrame:
    """Originals ranked by views per million; the first ``top`` of them."""
    vpm = F.col("views_per_million")
    r = global_rank(content_roi(wh), "views_per_million", ascending=False, out="roi_rank")
    out = r.select(
        F.col("roi_rank").cast("int").alias("roi_rank"), "title", "content_type", "genre", "cost_tier",
        money_label(F.col("production_cost_usd")).alias("budget"), "total_views",
        "unique_viewers", "total_watch_min", "completion_pct", "views_per_million",
        "minutes_per_million",
        F.when(vpm >= 500, "STRONG").when(vpm >= 200, "GOOD").when(vpm >= 100, "MODERATE")
        .otherwise("UNDERPERFORMING").alias("roi_verdict"))
    return out.orderBy("roi_rank", "title").limit(top)


def q7_dense_rank(wh: Warehouse) -> DataFrame:
    """RANK and DENSE_RANK side by side on views per million (all originals)."""
    r = global_rank(content_roi(wh), "views_per_million", ascending=False, out="roi_rank",
                    extra={"roi_dense_rank": "dense_rank"})
    return r.select("title", "views_per_million", F.col("roi_rank").cast("int").alias("roi_rank"),
                    F.col("roi_dense_rank").cast("int").alias("roi_dense_rank"))


# ---- checks written next to the fact and mart builds ------------------------

def events_by_period(wh: Warehouse) -> DataFrame:
    return wh.fve.groupBy("day_period").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.round(mysql_avg("watch_duration_minutes", 2), 1).alias("avg_watch_min")) \
        .orderBy(F.col("event_count").desc())


def events_by_calendar(wh: Warehouse) -> DataFrame:
    """Viewing events by calendar week (0..53), month and quarter, with month
    starts and ends apart. Events are counted by day before they meet the
    calendar, which has 2,922 rows."""
    days = wh.fve.groupBy("date_key").agg(F.count(F.lit(1)).alias("events"))
    by = ["yr", "quarter", "month_number", "month_name", "week_of_year", "is_month_start", "is_month_end"]
    return days.join(F.broadcast(wh.dim_date), "date_key").groupBy(*by).agg(
        F.count(F.lit(1)).alias("days"), F.sum("events").alias("events"), F.min("day_of_year").alias("first_day_of_year"),
        F.max("day_of_month").alias("last_day_of_month"))


def subs_by_plan_status(wh: Warehouse) -> DataFrame:
    fs = wh.fact_subscriptions
    return fs.groupBy("plan_type", "status").agg(
        F.count(F.lit(1)).alias("sub_count"),
        F.round(mysql_avg("duration_days"), 0).alias("avg_duration_days"),
        F.round(mysql_avg("estimated_ltv", 2), 2).alias("avg_ltv"),
        F.min("plan_rank").alias("plan_rank")).orderBy("plan_rank", "status")


def session_depth(wh: Warehouse) -> DataFrame:
    so = F.col("session_order")
    bucket = (F.when(so == 1, "1 view").when(so <= 3, "2-3 views").when(so <= 5, "4-5 views")
              .otherwise("6+ views"))
    return wh.fact_viewing_events.groupBy(bucket.alias("session_depth")).agg(
        F.count(F.lit(1)).alias("event_count"), F.min(so).alias("_first")) \
        .orderBy("_first").drop("_first")


def users_by_risk(wh: Warehouse) -> DataFrame:
    return wh.mart_user_engagement.groupBy("churn_risk").agg(F.count(F.lit(1)).alias("users")) \
        .orderBy(F.col("users").desc())


def budget_band_of(cost):
    return (F.when(cost.between(500000, 700000), "500K-700K")
            .when(cost >= 10000000, "10M+").otherwise("other"))


def roi_by_budget_band(wh: Warehouse) -> DataFrame:
    """Views per million dollars of originals by budget band (mid-budget
    500K-700K against 10M and above): total views over total cost."""
    dc = wh.dim_content.filter(F.col("is_original") & F.col("production_cost_usd").isNotNull())
    j = dc.join(wh.content_stats, "content_id", "left")
    g = j.groupBy(budget_band_of(F.col("production_cost_usd")).alias("budget_band")).agg(
        F.count(F.lit(1)).alias("titles"),
        F.sum(F.coalesce("total_views", F.lit(0))).alias("total_views"),
        F.sum("production_cost_usd").alias("_cost"))
    return g.select("budget_band", "titles", "total_views",
                    F.round(mysql_div(F.col("total_views"),
                                      mysql_div(F.col("_cost"), F.lit(1000000), 2), 0), 1)
                    .alias("views_per_million"))


def titles_by_inactivity(wh: Warehouse, days: int = 14) -> DataFrame:
    """Mean titles watched: users inactive ``days``+ days against the rest."""
    ua = user_activity(wh)
    return ua.groupBy((F.col("days_inactive") >= days).alias("inactive_14d")).agg(
        F.count(F.lit(1)).alias("users"),
        F.round(mysql_avg("unique_titles"), 1).alias("avg_titles"))
