"""Declared schemas of the four raw (staging) tables. Never inferred."""
from __future__ import annotations

from pyspark.sql import types as T

RAW_USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("username", T.StringType(), False),
    T.StructField("country", T.StringType(), True),
    T.StructField("signup_date", T.TimestampNTZType(), False),
    T.StructField("birth_year", T.IntegerType(), True),
])

RAW_SUBSCRIPTIONS = T.StructType([
    T.StructField("subscription_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("plan_type", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), True),
    T.StructField("monthly_price", T.DecimalType(6, 2), False),
])

RAW_CONTENT = T.StructType([
    T.StructField("content_id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("content_type", T.StringType(), False),
    T.StructField("genre", T.StringType(), False),
    T.StructField("release_year", T.IntegerType(), False),
    T.StructField("duration_minutes", T.IntegerType(), False),
    T.StructField("rating", T.StringType(), True),
    T.StructField("is_original", T.BooleanType(), False),
    T.StructField("production_cost_usd", T.DecimalType(12, 2), True),
])

RAW_VIEWING_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("content_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("device_type", T.StringType(), False),
    T.StructField("watch_duration_sec", T.IntegerType(), False),
    T.StructField("event_timestamp", T.TimestampNTZType(), False),
])

RAW_SCHEMAS = {
    "raw_users": RAW_USERS,
    "raw_subscriptions": RAW_SUBSCRIPTIONS,
    "raw_content": RAW_CONTENT,
    "raw_viewing_events": RAW_VIEWING_EVENTS,
}

# Value lists of the coded columns (used by data-quality domain checks).
PLAN_TYPES = ("free_trial", "basic", "standard", "premium")
SUB_STATUSES = ("active", "cancelled", "expired", "paused")
CONTENT_TYPES = ("movie", "series", "documentary", "short")
EVENT_TYPES = ("play", "pause", "resume", "complete", "abandon")
DEVICE_TYPES = ("smart_tv", "mobile", "tablet", "desktop", "console")

# Declared text widths of the raw columns.
MAX_LENGTHS = {
    "raw_users": {"user_id": 36, "email": 255, "username": 100, "country": 3},
    "raw_subscriptions": {"subscription_id": 36, "user_id": 36, "plan_type": 20, "status": 20},
    "raw_content": {"content_id": 36, "title": 255, "content_type": 20, "genre": 50, "rating": 10},
    "raw_viewing_events": {"event_id": 36, "user_id": 36, "content_id": 36, "event_type": 20,
                           "device_type": 30},
}
