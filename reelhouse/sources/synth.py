"""Seeded synthetic source for the four raw tables, built from ``spark.range``.

Every value is a function of (seed, table, row id, field) through a 64-bit
hash, so the rows are identical for any number of partitions or executors
and generation scales out like any other scan. The shape follows the
warehouse's generator: weighted plan / status / event / device choices,
heavy viewers (a fifth of the users produce about 60% of events), evening
skew, about 3% duplicate e-mails and 5% invalid birth years.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import COUNTRIES, GENRES, INVALID_BIRTH_YEARS, PLAN_PRICES, RATINGS, RawTables

# ---- fixed values (generator weights and ranges) ----------------------------
PLAN_WEIGHTS = [("free_trial", 15), ("basic", 35), ("standard", 35), ("premium", 15)]
STATUS_WEIGHTS = [("active", 45), ("cancelled", 25), ("expired", 20), ("paused", 10)]
EVENT_WEIGHTS = [("play", 40), ("pause", 15), ("resume", 15), ("complete", 20), ("abandon", 10)]
DEVICE_WEIGHTS = [("smart_tv", 30), ("mobile", 30), ("tablet", 15), ("desktop", 15), ("console", 10)]
DURATION_RANGES = {"movie": (80, 180), "series": (25, 60), "documentary": (45, 120), "short": (5, 25)}
DATE_START, DATE_END = "2023-01-01", "2025-12-31"
# -----------------------------------------------------------------------------

_TWO63 = float(2 ** 63)


def _u(seed: int, table: str, field: str) -> Column:
    """Uniform [0, 1) from the row id."""
    h = F.xxhash64(F.lit(seed), F.lit(table), F.col("id"), F.lit(field))
    return F.abs(h.cast("double")) / F.lit(_TWO63)


def _int(u: Column, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi]."""
    return (F.lit(lo) + F.floor(u * (hi - lo + 1))).cast("int")


def _weighted(u: Column, choices) -> Column:
    total = float(sum(w for _, w in choices))
    acc, expr = 0.0, None
    for value, w in choices:
        acc += w / total
        expr = F.when(u < acc, value) if expr is None else expr.when(u < acc, value)
    return expr.otherwise(choices[-1][0])


def _pick(u: Column, values, dtype="string") -> Column:
    arr = F.array(*[F.lit(v).cast(dtype) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def _id(prefix: str, seed: int) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("-", F.lit(seed), F.lit(prefix),
                                                                    F.col("id").cast("string")), 256), 1, 24))


def synth_tables(spark: SparkSession, n_users: int = 500, n_content: int = 200, n_subs: int = 2000,
                 n_events: int = 50000, seed: int = 42, partitions: int | None = None) -> RawTables:
    start = F.to_timestamp(F.lit(DATE_START + " 00:00:00")).cast("timestamp_ntz")
    span_days = 1095  # DATE_START .. DATE_END

    def rng(n):
        return spark.range(0, n, 1, partitions) if partitions else spark.range(n)

    # users
    u = rng(n_users)
    dup = (_u(seed, "u", "dup") < 0.03) & (F.col("id") > 0)
    src = F.when(dup, F.floor(_u(seed, "u", "dupof") * F.col("id"))).otherwise(F.col("id"))
    bad_year = _u(seed, "u", "badyear") < 0.05
    users = u.select(
        _id("u", seed).alias("user_id"),
        F.concat(F.lit("viewer"), src.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("user_"), F.col("id").cast("string")).alias("username"),
        _pick(_u(seed, "u", "country"), COUNTRIES).alias("country"),
        (start + F.make_dt_interval(days=_int(_u(seed, "u", "day"), 0, span_days),
                                    secs=_int(_u(seed, "u", "sec"), 0, 86399))).alias("signup_date"),
        F.when(bad_year, _pick(_u(seed, "u", "bad"), INVALID_BIRTH_YEARS, "int"))
        .otherwise(_int(_u(seed, "u", "year"), 1960, 2005)).alias("birth_year"),
        F.col("id").alias("_uid"))

    # content
    c = rng(n_content)
    ctype = _pick(_u(seed, "c", "type"), list(DURATION_RANGES))
    dur = None
    for t, (lo, hi) in DURATION_RANGES.items():
        v = _int(_u(seed, "c", "dur"), lo, hi)
        dur = F.when(ctype == t, v) if dur is None else dur.when(ctype == t, v)
    original = _u(seed, "c", "orig") < 0.30
    cost_u = _u(seed, "c", "cost")
    cost = F.when(original, F.round(F.lit(500000.0) + cost_u * 49500000.0, 2)) \
        .otherwise(F.round(F.lit(10000.0) + cost_u * 1990000.0, 2))
    content = c.select(
        _id("c", seed).alias("content_id"), F.concat(F.lit("Title "), F.col("id").cast("string")).alias("title"),
        ctype.alias("content_type"), _pick(_u(seed, "c", "genre"), GENRES).alias("genre"),
        _int(_u(seed, "c", "year"), 2015, 2025).alias("release_year"), dur.alias("duration_minutes"),
        _pick(_u(seed, "c", "rating"), RATINGS).alias("rating"), original.alias("is_original"),
        cost.cast("decimal(12,2)").alias("production_cost_usd"), F.col("id").alias("_cid"))

    # subscriptions: start after the user's signup
    s = rng(n_subs).withColumn("_uid", F.floor(_u(seed, "s", "user") * n_users))
    s = s.join(users.select("_uid", "user_id", "signup_date"), "_uid")
    plan = _weighted(_u(seed, "s", "plan"), PLAN_WEIGHTS)
    status = _weighted(_u(seed, "s", "status"), STATUS_WEIGHTS)
    signup = F.to_date("signup_date")
    room = F.datediff(F.to_date(F.lit(DATE_END)), signup)
    begin = F.date_add(signup, F.floor(_u(seed, "s", "start") * (room + 1)).cast("int"))
    end = F.least(F.date_add(begin, _int(_u(seed, "s", "len"), 14, 365)), F.to_date(F.lit(DATE_END)))
    price = None
    for p, v in PLAN_PRICES.items():
        price = (F.when(plan == p, F.lit(Decimal(v))) if price is None else price.when(plan == p, F.lit(Decimal(v))))
    subs = s.select(_id("s", seed).alias("subscription_id"), "user_id", plan.alias("plan_type"),
                    status.alias("status"), begin.alias("start_date"),
                    F.when(status != "active", end).alias("end_date"),
                    price.cast("decimal(6,2)").alias("monthly_price"))

    # events: 60% from the heaviest fifth of users, evening skew
    heavy = max(1, int(n_users * 0.2))
    e = rng(n_events)
    uid = F.when(_u(seed, "e", "heavy") < 0.6, F.floor(_u(seed, "e", "hu") * heavy)) \
        .otherwise(F.floor(_u(seed, "e", "au") * n_users))
    e = e.withColumn("_uid", uid).withColumn("_cid", F.floor(_u(seed, "e", "content") * n_content))
    e = e.join(users.select("_uid", "user_id"), "_uid").join(
        content.select("_cid", "content_id", "duration_minutes"), "_cid")
    etype = _weighted(_u(seed, "e", "type"), EVENT_WEIGHTS)
    max_sec = F.col("duration_minutes") * 60
    w = _u(seed, "e", "watch")
    sec = (F.when(etype == "complete", max_sec)
           .when(etype == "abandon", F.lit(30) + F.floor(w * F.greatest(F.floor(max_sec * 0.3) - 29, F.lit(1))))
           .when(etype == "play", F.lit(60) + F.floor(w * F.greatest(F.floor(max_sec * 0.8) - 59, F.lit(1))))
           .otherwise(F.lit(10) + F.floor(w * F.greatest(F.floor(max_sec * 0.5) - 9, F.lit(1)))))
    hour = F.when(_u(seed, "e", "evening") < 0.6, _int(_u(seed, "e", "eh"), 18, 23)) \
        .otherwise(_int(_u(seed, "e", "hour"), 0, 23))
    ts = start + F.make_dt_interval(days=_int(_u(seed, "e", "day"), 0, span_days), hours=hour,
                                    mins=_int(_u(seed, "e", "min"), 0, 59), secs=_int(_u(seed, "e", "sec"), 0, 59))
    events = e.select(_id("e", seed).alias("event_id"), "user_id", "content_id", etype.alias("event_type"),
                      _weighted(_u(seed, "e", "device"), DEVICE_WEIGHTS).alias("device_type"),
                      F.greatest(sec, F.lit(1)).cast("int").alias("watch_duration_sec"),
                      ts.alias("event_timestamp"))
    return RawTables(users=users.drop("_uid"), subscriptions=subs, content=content.drop("_cid"),
                     viewing_events=events)
