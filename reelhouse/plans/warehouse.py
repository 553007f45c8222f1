"""The warehouse: dimensions, facts, marts and views as lazy DataFrames.

``Warehouse(spark, sf_dir)`` exposes each table as a property; nothing is
executed until a caller runs an action on a result. Shared intermediate
aggregates (per user-title pairs, per title stats) are built once per
warehouse object, so one query plan reuses their exchanges.

Scale notes
* Deduplication and "latest row" use ``min``/``max`` over structs (hash
  aggregate with map-side combine) instead of ROW_NUMBER windows, so a hot
  e-mail or user costs one partial row per task.
* Event-level work is aggregated before joining dimensions ("aggregate
  before join"), so the content and user dimensions meet per-pair or
  per-title rows, not raw events.
* Only the 5-row literal device table is broadcast by hint; every other join
  is left to AQE, which broadcasts only after measuring the side's size.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (date_key, day_name, dec, month_name, mysql_avg, mysql_div,
                         mysql_week_monday, same_text, ym_label)
from ..operators.overlap import active_by_month
from ..operators.rank import global_rank
from ..operators.stored import store
from ..sources.adapters import RawTables, raw_tables

# ---- fixed values (warehouse rules) ---------------------------------------
DEVICES = [("smart_tv", "living_room"), ("mobile", "mobile"), ("tablet", "mobile"),
           ("desktop", "desktop"), ("console", "living_room")]
REGIONS = [
    ("North America", ["USA", "CAN", "MEX"]),
    ("Europe", ["GBR", "DEU", "FRA", "ITA", "ESP", "NLD", "SWE", "NOR", "POL"]),
    ("South America", ["BRA", "ARG", "COL"]),
    ("Asia Pacific", ["JPN", "KOR", "IDN", "THA", "IND"]),
    ("Middle East", ["TUR", "EGY", "SAU"]),
    ("Oceania", ["AUS"]),
]
AGE_GROUPS = [(1930, 1964, "60+"), (1965, 1980, "45-59"), (1981, 1996, "28-44"),
              (1997, 2005, "18-27"), (2006, 2010, "Under 18")]
PLAN_RANK = {"free_trial": 1, "basic": 2, "standard": 3, "premium": 4}
CALENDAR_FIRST, CALENDAR_LAST = "2020-01-01", "2027-12-31"
REPORT_FIRST, REPORT_LAST = "2023-01-01", "2025-12-31"
#: Events that one task groups, on average: bounds its memory whatever the table's size and compression.
EVENTS_PER_TASK = 1 << 20
# ---------------------------------------------------------------------------


def conform(df: DataFrame) -> DataFrame:
    """Output convention shared with the SQL oracle: integers as BIGINT,
    exact decimals (already rounded) as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def region_of(country: Column) -> Column:
    expr = None
    for name, codes in REGIONS:
        cond = country.isin(*codes)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("Other")


def age_group_of(year: Column) -> Column:
    expr = None
    for lo, hi, label in AGE_GROUPS:
        cond = year.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("Unknown")


def day_period_of(hour: Column) -> Column:
    return (F.when(hour.between(6, 11), "morning").when(hour.between(12, 17), "afternoon")
            .when(hour.between(18, 22), "evening").otherwise("night"))


def churn_risk_of(days: Column) -> Column:
    return (F.when(days.isNull(), "new").when(days > 60, "churned").when(days > 30, "high")
            .when(days > 14, "medium").otherwise("low"))


def completion_rate(completed: Column, abandoned: Column, digits: int) -> Column:
    """ROUND(c * 100.0 / (c + a), digits); NULL when there are none."""
    return F.round(mysql_div(completed * dec("100.0"), completed + abandoned, 1), digits)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, raw: RawTables | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.raw = raw if raw is not None else raw_tables(spark, sf_dir)

    # ---- reference date --------------------------------------------------
    @cached_property
    def as_of(self) -> Column:
        """Latest event date of the viewing fact, as a scalar subquery over one
        column of the stored events: no shuffle but that of one row a task."""
        return self.events.agg(F.max("event_date")).scalar()

    # ---- dimensions ------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        d = F.col("full_date")
        dow = F.dayofweek(d)
        cal = self.spark.range(1).select(F.explode(F.sequence(
            F.to_date(F.lit(CALENDAR_FIRST)), F.to_date(F.lit(CALENDAR_LAST)),
            F.expr("interval 1 day"))).alias("full_date"))
        return cal.select(
            date_key(d).alias("date_key"), d,
            dow.alias("day_of_week"), day_name(d).alias("day_name"),
            F.dayofmonth(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"),
            mysql_week_monday(d).alias("week_of_year"), F.month(d).alias("month_number"),
            month_name(d).alias("month_name"), F.quarter(d).alias("quarter"),
            F.year(d).alias("yr"), dow.isin(1, 7).alias("is_weekend"),
            (F.dayofmonth(d) == 1).alias("is_month_start"),
            (d == F.last_day(d)).alias("is_month_end"), ym_label(d).alias("ym_label"))

    @cached_property
    def dim_device(self) -> DataFrame:
        rows = [(i + 1, t, c) for i, (t, c) in enumerate(DEVICES)]
        return self.spark.createDataFrame(
            rows, "device_key int, device_type string, device_category string")

    @cached_property
    def deduplicated_users(self) -> DataFrame:
        """One row per e-mail, compared without case, accents and trailing
        spaces: the earliest signup (ties: smallest user_id), in its spelling."""
        u = self.raw.users
        first = F.min(F.struct("signup_date", "user_id", "username", "country", "birth_year", "email"))
        return u.groupBy(same_text("email")).agg(first.alias("f")).select(
            "f.user_id", "f.email", "f.username", "f.country", "f.signup_date", "f.birth_year")

    @cached_property
    def latest_subscriptions(self) -> DataFrame:
        """Per user, the subscription with the latest start (ties: largest id)."""
        s = self.raw.subscriptions
        last = F.max(F.struct("start_date", "subscription_id", "plan_type", "status"))
        return s.groupBy("user_id").agg(last.alias("l")).select(
            "user_id", F.col("l.plan_type").alias("plan_type"), F.col("l.status").alias("status"))

    @cached_property
    def dim_users(self) -> DataFrame:
        du = self.deduplicated_users
        ls = self.latest_subscriptions
        by = F.col("birth_year")
        signup = F.to_date("signup_date")
        return du.join(ls, "user_id", "left").select(
            "user_id", "email", "username", "country",
            signup.alias("signup_date"), date_key(signup).alias("signup_date_key"),
            F.when(by.between(1930, 2010), by).alias("birth_year"),
            age_group_of(by).alias("age_group"), region_of(F.col("country")).alias("region"),
            F.datediff(self.as_of, signup).alias("days_since_signup"),
            F.col("plan_type").alias("current_plan_type"),
            F.col("status").alias("current_plan_status"))

    @cached_property
    def dim_content(self) -> DataFrame:
        c = self.raw.content
        dur = F.col("duration_minutes")
        cost = F.col("production_cost_usd")
        return c.select(
            "content_id", "title", "content_type", "genre", "release_year",
            F.concat((F.floor(F.col("release_year") / 10) * 10).cast("int").cast("string"),
                     F.lit("s")).alias("decade"),
            "duration_minutes",
            F.when(dur <= 15, "short").when(dur <= 45, "medium").when(dur <= 90, "long")
            .otherwise("feature").alias("duration_bucket"),
            "rating", "is_original", "production_cost_usd",
            F.when(cost.isNull(), F.lit(None).cast("string")).when(cost < 100000, "low")
            .when(cost < 1000000, "medium").when(cost < 10000000, "high")
            .otherwise("premium").alias("cost_tier"))

    # ---- facts -------------------------------------------------------------
    def _event_rows(self, with_session_order: bool) -> DataFrame:
        e = self.raw.viewing_events
        ts = F.col("event_timestamp")
        hour = F.hour(ts)
        j = e.join(F.broadcast(self.dim_device.select("device_type", "device_key")), "device_type")
        cols = [
            "event_id", "user_id", "content_id", date_key(ts).alias("date_key"), "device_key",
            "event_type", "device_type", "watch_duration_sec",
            F.round(mysql_div(F.col("watch_duration_sec"), F.lit(60), 0), 2)
            .cast("decimal(8,2)").alias("watch_duration_minutes"),
            (F.col("event_type") == "complete").alias("is_completed"),
            (F.col("event_type") == "abandon").alias("is_abandoned"),
            hour.alias("hour_of_day"), day_period_of(hour).alias("day_period"),
            ts.alias("event_timestamp")]
        if with_session_order:
            w = Window.partitionBy("user_id", F.to_date(ts)).orderBy(ts, F.col("event_id"))
            return j.select(*cols, F.row_number().over(w).alias("session_order"))
        return j.select(*cols, F.to_date(ts).alias("event_date"))

    @cached_property
    def fact_viewing_events(self) -> DataFrame:
        """The viewing fact: keys, minutes, flags, hour, day period and the
        nth event of the user's day (a window partitioned by user and day)."""
        return self._event_rows(with_session_order=True)

    @cached_property
    def fve(self) -> DataFrame:
        """The fact without its session window (for aggregates that do not
        need ``session_order``; avoids the window's shuffle and sort)."""
        return self._event_rows(with_session_order=False)

    @cached_property
    def fact_subscriptions(self) -> DataFrame:
        s = self.raw.subscriptions
        end, start = F.col("end_date"), F.col("start_date")
        days = F.datediff(end, start)
        months = mysql_div(days, dec("30.44"), 0)
        plan = F.col("plan_type")
        rank = None
        for p, r in PLAN_RANK.items():
            rank = F.when(plan == p, r) if rank is None else rank.when(plan == p, r)
        return s.select(
            "subscription_id", "user_id", "plan_type", rank.alias("plan_rank"), "status",
            (F.col("status") == "active").alias("is_active"), "start_date",
            date_key(start).alias("start_date_key"), "end_date",
            F.when(end.isNotNull(), date_key(end)).alias("end_date_key"),
            "monthly_price",
            F.when(end.isNotNull(), days).alias("duration_days"),
            F.when(end.isNotNull(), F.round(months, 1)).cast("decimal(5,1)").alias("duration_months"),
            F.when(end.isNotNull() & (F.col("monthly_price") > 0),
                   F.round(F.col("monthly_price") * months, 2)).cast("decimal(10,2)")
            .alias("estimated_ltv"))

    # ---- shared aggregates -------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        """The columns of the fact that the aggregates read, stored once: the
        joins of the raw tables run once a warehouse, not once an aggregate."""
        return store(self.fve.select("user_id", "content_id", "device_type", "event_date", "is_completed",
                                     "is_abandoned", "watch_duration_minutes"), "events")

    @cached_property
    def _event_tasks(self) -> int:
        return max(self.spark.sparkContext.defaultParallelism, -(-self.events.count() // EVENTS_PER_TASK))

    def _dealt_events(self, *keys: str) -> DataFrame:
        """The events dealt by ``keys`` to as many tasks as their number needs.
        Grouped by these keys they need no other shuffle. Nearly all keys are
        distinct, so grouping what a scan task reads would save little, and
        such a task may read 128 MB of compressed rows."""
        return self.events.repartition(self._event_tasks, *keys)

    @cached_property
    def pairs(self) -> DataFrame:
        """Per (user, title): events, completions, abandons, exact minutes."""
        f = self._dealt_events("user_id", "content_id")
        return f.groupBy("user_id", "content_id").agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum(F.col("is_completed").cast("int")).alias("completions"),
            F.sum(F.col("is_abandoned").cast("int")).alias("abandons"),
            F.sum("watch_duration_minutes").alias("minutes"))

    def keep_pairs(self) -> None:
        """Store ``pairs`` for a query that reads them more than once."""
        self.pairs = store(self.pairs, "pairs")

    @cached_property
    def user_days(self) -> DataFrame:
        """Per (user, day): events, completions, abandons, exact minutes."""
        f = self._dealt_events("user_id", "event_date")
        return f.groupBy("user_id", "event_date").agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum(F.col("is_completed").cast("int")).alias("completions"),
            F.sum(F.col("is_abandoned").cast("int")).alias("abandons"),
            F.sum("watch_duration_minutes").alias("minutes"))

    @cached_property
    def content_stats(self) -> DataFrame:
        """Per title: views, unique viewers, completions, abandons, minutes."""
        return self.pairs.groupBy("content_id").agg(
            F.sum("n_events").alias("total_views"),
            F.count(F.lit(1)).alias("unique_viewers"),
            F.sum("completions").alias("total_completions"),
            F.sum("abandons").alias("total_abandons"),
            F.sum("minutes").alias("minutes"))

    @cached_property
    def user_viewing_stats(self) -> DataFrame:
        ud = self.user_days.groupBy("user_id").agg(
            F.sum("n_events").alias("total_watch_events"),
            F.round(F.sum("minutes"), 2).alias("total_watch_minutes"),
            F.sum("completions").alias("total_completed"),
            F.sum("abandons").alias("total_abandoned"),
            F.count(F.lit(1)).alias("distinct_days_active"),
            F.min("event_date").alias("first_watch_date"),
            F.max("event_date").alias("last_watch_date"))
        titles = self.pairs.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("distinct_content_watched"))
        return ud.join(titles, "user_id")

    @cached_property
    def user_top_device(self) -> DataFrame:
        """Most used device per user; ties by device name."""
        c = self.events.groupBy("user_id", "device_type").agg(F.count(F.lit(1)).alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("device_type")))
        return c.groupBy("user_id").agg(best.alias("b")).select(
            "user_id", F.col("b.device_type").alias("favorite_device"))

    @cached_property
    def user_top_genre(self) -> DataFrame:
        """Most watched genre per user (events); ties by genre name."""
        g = self.pairs.join(self.dim_content.select("content_id", "genre"), "content_id") \
            .groupBy("user_id", "genre").agg(F.sum("n_events").alias("n"))
        best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("genre")))
        return g.groupBy("user_id").agg(best.alias("b")).select(
            "user_id", F.col("b.genre").alias("favorite_genre"))

    # ---- marts -------------------------------------------------------------
    @cached_property
    def mart_user_engagement(self) -> DataFrame:
        du = self.dim_users
        s = self.user_viewing_stats
        j = (du.join(s, "user_id", "left").join(self.user_top_device, "user_id", "left")
             .join(self.user_top_genre, "user_id", "left"))
        c = F.coalesce(F.col("total_completed"), F.lit(0))
        a = F.coalesce(F.col("total_abandoned"), F.lit(0))
        days_active = F.coalesce(F.col("distinct_days_active"), F.lit(0))
        since = F.datediff(self.as_of, F.col("last_watch_date"))
        return j.select(
            "user_id", "username", "region", "age_group",
            F.col("current_plan_type").alias("current_plan"), "signup_date", "days_since_signup",
            F.coalesce("total_watch_events", F.lit(0)).alias("total_watch_events"),
            F.coalesce("total_watch_minutes", F.lit(0)).cast("decimal(20,2)").alias("total_watch_minutes"),
            c.alias("total_completed"), a.alias("total_abandoned"),
            F.when(c + a > 0, completion_rate(c, a, 2)).cast("decimal(5,2)").alias("completion_rate"),
            F.coalesce("distinct_content_watched", F.lit(0)).alias("distinct_content_watched"),
            days_active.alias("distinct_days_active"),
            "favorite_device", "favorite_genre",
            F.when(days_active > 0, F.round(mysql_div(F.col("total_watch_minutes"),
                                                      F.col("distinct_days_active"), 2), 2))
            .cast("decimal(8,2)").alias("avg_daily_watch_min"),
            "first_watch_date", "last_watch_date",
            F.when(F.col("last_watch_date").isNotNull(), since).alias("days_since_last_watch"),
            churn_risk_of(F.when(F.col("last_watch_date").isNotNull(), since)).alias("churn_risk"))

    @cached_property
    def mart_content_performance(self) -> DataFrame:
        dc = self.dim_content
        s = self.content_stats
        j = dc.join(s, "content_id", "left")
        views = F.coalesce(F.col("total_views"), F.lit(0))
        comp = F.coalesce(F.col("total_completions"), F.lit(0))
        ab = F.coalesce(F.col("total_abandons"), F.lit(0))
        minutes = F.coalesce(F.round(F.col("minutes"), 2), F.lit(0)).cast("decimal(20,2)")
        cost = F.col("production_cost_usd")
        out = j.select(
            "content_id", "title", "content_type", "genre", "release_year", "duration_minutes",
            "duration_bucket", "is_original", "production_cost_usd", "cost_tier",
            views.alias("total_views"),
            F.coalesce(F.col("unique_viewers"), F.lit(0)).alias("unique_viewers"),
            comp.alias("total_completions"), ab.alias("total_abandons"),
            F.when(comp + ab > 0, completion_rate(comp, ab, 2)).cast("decimal(5,2)")
            .alias("completion_rate"),
            minutes.alias("total_watch_minutes"),
            F.round(mysql_div(F.col("minutes"), F.col("total_views"), 2), 2).cast("decimal(8,2)")
            .alias("avg_watch_minutes"),
            F.when(cost > 0, F.round(mysql_div(views, cost, 0), 6)).cast("decimal(10,6)")
            .alias("views_per_dollar"),
            F.when(cost > 0, F.round(mysql_div(minutes, cost, 2), 6)).cast("decimal(10,6)")
            .alias("minutes_per_dollar"))
        return global_rank(out, "total_views", ascending=False, out="popularity_rank") \
            .withColumn("popularity_rank", F.col("popularity_rank").cast("int"))

    @cached_property
    def report_months(self) -> DataFrame:
        d = self.dim_date
        return d.filter(F.col("full_date").between(F.to_date(F.lit(REPORT_FIRST)),
                                                   F.to_date(F.lit(REPORT_LAST)))) \
            .select(F.col("ym_label").alias("ym")).distinct()

    @cached_property
    def mart_subscription_metrics(self) -> DataFrame:
        fs = self.fact_subscriptions
        months = self.report_months
        new = fs.groupBy(ym_label("start_date").alias("ym")).agg(F.count(F.lit(1)).alias("new_cnt"))
        ended = fs.filter(F.col("end_date").isNotNull()) \
            .groupBy(ym_label("end_date").alias("ym")).agg(F.count(F.lit(1)).alias("end_cnt"))
        plan = F.col("plan_type")
        measures = {
            "ft": (plan == "free_trial").cast("bigint"), "ba": (plan == "basic").cast("bigint"),
            "st": (plan == "standard").cast("bigint"), "pr": (plan == "premium").cast("bigint"),
            "total_active": F.lit(1).cast("bigint"),
            "revenue": F.col("monthly_price").cast("decimal(20,2)"),
        }
        act = active_by_month(fs, "start_date", "end_date", months, measures)
        j = months.join(new, "ym", "left").join(ended, "ym", "left").join(act, "ym", "left")
        n = F.coalesce(F.col("new_cnt"), F.lit(0))
        e = F.coalesce(F.col("end_cnt"), F.lit(0))
        tot = F.coalesce(F.col("total_active"), F.lit(0))
        ft = F.coalesce(F.col("ft"), F.lit(0))
        rev = F.coalesce(F.col("revenue"), F.lit(0))
        return j.select(
            "ym", n.alias("new_subscriptions"), e.alias("ended_subscriptions"),
            (n - e).alias("net_change"), ft.alias("active_free_trial"),
            F.coalesce("ba", F.lit(0)).alias("active_basic"),
            F.coalesce("st", F.lit(0)).alias("active_standard"),
            F.coalesce("pr", F.lit(0)).alias("active_premium"),
            tot.alias("total_active"),
            F.round(rev, 2).cast("decimal(20,2)").alias("monthly_revenue"),
            F.when(tot - ft > 0, F.round(mysql_div(rev, tot - ft, 2), 2)).cast("decimal(8,2)")
            .alias("avg_revenue_per_user"))

    # ---- views -------------------------------------------------------------
    LAYERS = ("dim_date", "dim_device", "dim_users", "dim_content", "fact_viewing_events",
              "fact_subscriptions", "mart_user_engagement", "mart_content_performance",
              "mart_subscription_metrics", "v_daily_active_users", "v_content_leaderboard",
              "v_churn_risk_summary")

    def register_views(self) -> list[str]:
        """Expose every layer to SQL as a session view (``spark.sql`` can then
        query the warehouse by name, as the notebook does)."""
        for name in self.LAYERS:
            getattr(self, name).createOrReplaceTempView(name)
        for short, df in (("raw_users", self.raw.users), ("raw_subscriptions", self.raw.subscriptions),
                          ("raw_content", self.raw.content), ("raw_viewing_events", self.raw.viewing_events)):
            df.createOrReplaceTempView(short)
        return list(self.LAYERS)

    @cached_property
    def daily_fact(self) -> DataFrame:
        """Per day: distinct users, exact minutes, events (pre-aggregated
        from user-days, so the distinct count needs no extra shuffle)."""
        return self.user_days.groupBy("event_date").agg(
            F.count(F.lit(1)).alias("dau"), F.sum("minutes").alias("minutes"),
            F.sum("n_events").alias("events"))

    @cached_property
    def v_daily_active_users(self) -> DataFrame:
        dd = self.dim_date.filter(F.col("full_date").between(
            F.to_date(F.lit(REPORT_FIRST)), F.to_date(F.lit(REPORT_LAST))))
        j = dd.join(self.daily_fact, dd.full_date == F.col("event_date"), "left")
        return j.select(
            "full_date", "day_name", "ym_label", "is_weekend",
            F.coalesce("dau", F.lit(0)).alias("daily_active_users"),
            F.col("minutes").alias("total_watch_minutes"),
            F.coalesce("events", F.lit(1)).alias("total_events"),
            F.coalesce("events", F.lit(0)).alias("event_count"))

    @cached_property
    def v_content_leaderboard(self) -> DataFrame:
        return self.mart_content_performance.select(
            "popularity_rank", "title", "content_type", "genre", "is_original", "total_views",
            "unique_viewers", "completion_rate", "total_watch_minutes", "views_per_dollar",
            "cost_tier")

    @cached_property
    def v_churn_risk_summary(self) -> DataFrame:
        m = self.mart_user_engagement
        return m.groupBy("churn_risk", "current_plan", "region").agg(
            F.count(F.lit(1)).alias("user_count"),
            F.round(mysql_avg("total_watch_minutes", 2), 1).alias("avg_watch_minutes"),
            F.round(mysql_avg("distinct_days_active"), 1).alias("avg_days_active"),
            F.round(mysql_avg("days_since_last_watch"), 0).alias("avg_days_since_watch"))


class BuiltWarehouse(Warehouse):
    """A warehouse whose layers were written by ``sources.io.build_warehouse``:
    analysis queries read the stored Parquet tables (facts partitioned by
    month) instead of re-deriving every layer from the raw tables."""

    STORED = ("dim_users", "dim_content", "fact_subscriptions", "mart_user_engagement",
              "mart_content_performance", "mart_subscription_metrics")

    def __init__(self, spark: SparkSession, built_dir: str):
        self.spark = spark
        self.sf_dir = None
        self.built_dir = built_dir.rstrip("/")
        read = lambda n: spark.read.parquet(f"{self.built_dir}/{n}")
        self.raw = RawTables(users=read("raw_users"), subscriptions=read("raw_subscriptions"),
                             content=read("raw_content"), viewing_events=read("raw_viewing_events"))
        for name in self.STORED:
            self.__dict__[name] = read(name)
        fact = read("fact_viewing_events")
        self.__dict__["fact_viewing_events"] = fact.drop("ym")
        self.__dict__["fve"] = fact.drop("ym", "session_order").withColumn(
            "event_date", F.to_date("event_timestamp"))
        self.__dict__["events"] = self.__dict__["fve"]
        self.__dict__["as_of"] = fact.agg(F.max(F.to_date("event_timestamp"))).scalar()
