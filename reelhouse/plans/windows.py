"""Window operators the warehouse names without code: LAG gaps, sessions,
running totals, DENSE_RANK, surrogate keys."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import wall_micros
from ..operators.rank import global_rank
from ..operators.sessions import sessionize, with_gap
from ..sources.tables import read_table
from .warehouse import Warehouse

SESSION_GAP_SECONDS = 30 * 60
EVENTS_SESSION_GAP_SECONDS = 6 * 3600


def event_gap_lag(wh: Warehouse) -> DataFrame:
    """Seconds since the user's previous viewing event (LAG)."""
    f = wh.fve.select("event_id", "user_id", "event_timestamp")
    g = with_gap(f, "user_id", "event_timestamp", "event_id")
    return g.select("event_id", "user_id", "event_timestamp", "prev_event_timestamp", "gap_sec")


def sessions(wh: Warehouse) -> DataFrame:
    """Viewing sessions: new session after more than 30 minutes idle."""
    f = wh.fve.select("event_id", "user_id", "event_timestamp")
    s = sessionize(f, "user_id", "event_timestamp", "event_id", SESSION_GAP_SECONDS)
    return s.select("event_id", "user_id", "event_timestamp", "gap_sec", "is_new_session",
                    "session_no", "session_id")


def session_summary(wh: Warehouse) -> DataFrame:
    """Per session: events, start, end, length in seconds, minutes watched."""
    f = wh.fve.select("event_id", "user_id", "event_timestamp", "watch_duration_minutes")
    s = sessionize(f, "user_id", "event_timestamp", "event_id", SESSION_GAP_SECONDS)
    g = s.groupBy("user_id", "session_no").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.sum("watch_duration_minutes").alias("minutes"))
    return g.withColumn("length_sec", F.floor(
        (wall_micros(F.col("session_end")) - wall_micros(F.col("session_start"))) / F.lit(1000000)).cast("bigint"))


def events_sessions(spark, sf_dir: str) -> DataFrame:
    """Sessions on the 30-day ``events`` log, 6-hour idle gap."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts"]) \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    s = sessionize(ev, "user_id", "ts", "event_id", EVENTS_SESSION_GAP_SECONDS)
    return s.select("event_id", "user_id", "ts", "gap_sec", "is_new_session", "session_no")


def running_net_subs(wh: Warehouse) -> DataFrame:
    """Cumulative net subscriptions by month (one row per month)."""
    m = wh.mart_subscription_metrics.select("ym", "new_subscriptions", "ended_subscriptions",
                                            "net_change")
    w = Window.orderBy("ym").rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumn("cumulative_net", F.sum("net_change").over(w))


def surrogate_keys(wh: Warehouse) -> DataFrame:
    """Dense integer keys in natural-key order for users, titles and
    subscriptions, computed without a single-partition window."""
    u = global_rank(wh.dim_users.select(F.col("user_id").alias("natural_key")),
                    "natural_key", method="row_number", out="surrogate_key")
    c = global_rank(wh.dim_content.select(F.col("content_id").alias("natural_key")),
                    "natural_key", method="row_number", out="surrogate_key")
    s = global_rank(wh.raw.subscriptions.select(F.col("subscription_id").alias("natural_key")),
                    "natural_key", method="row_number", out="surrogate_key")
    return (u.withColumn("table_name", F.lit("dim_users"))
            .unionByName(c.withColumn("table_name", F.lit("dim_content")))
            .unionByName(s.withColumn("table_name", F.lit("fact_subscriptions")))
            .select("table_name", "natural_key", "surrogate_key"))


def event_keys(wh: Warehouse) -> DataFrame:
    """Fact surrogate key: dense row number of the event id."""
    return global_rank(wh.raw.viewing_events.select("event_id"), "event_id",
                       method="row_number", out="event_key")


def engagement_rank(wh: Warehouse) -> DataFrame:
    """RANK, DENSE_RANK and PERCENT_RANK of users by total minutes, whole table."""
    m = wh.mart_user_engagement.select("user_id", "total_watch_minutes")
    return global_rank(m, "total_watch_minutes", ascending=False, method="rank", out="minutes_rank",
                       extra={"minutes_dense_rank": "dense_rank",
                              "minutes_percent_rank": "percent_rank"})
