"""Adapters from the driver's TPC-H-style Parquet tables to the four raw
staging tables of the warehouse (users, subscriptions, content, viewing
events). Integer arithmetic only, so every engine derives identical rows.

users <- customer, subscriptions <- orders, content <- part, viewing events <-
lineitem joined to orders. Every row of each table is read.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# ---- fixed values (must equal the warehouse's source code lists) ----------
COUNTRIES = ["USA", "GBR", "CAN", "DEU", "FRA", "BRA", "JPN", "AUS",
             "IND", "TUR", "MEX", "KOR", "ITA", "ESP", "NLD", "SWE",
             "NOR", "POL", "ARG", "COL", "EGY", "SAU", "IDN", "THA"]
GENRES = ["Action", "Comedy", "Drama", "Horror", "Sci-Fi", "Romance",
          "Thriller", "Documentary", "Animation", "Fantasy", "Crime",
          "Mystery", "Adventure", "Family", "Music"]
RATINGS = ["G", "PG", "PG-13", "R", "TV-MA", "TV-14", "TV-PG"]
PLAN_PRICES = {"free_trial": "0.00", "basic": "7.99", "standard": "13.99", "premium": "19.99"}
INVALID_BIRTH_YEARS = [1800, 2030, 0, None, 1900]
# ---------------------------------------------------------------------------

DAY_SHIFT = 9131          # moves 1995-01-01 to 2020-01-01


def _sql_list(values) -> str:
    out = []
    for v in values:
        out.append("NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v)))
    return ", ".join(out)


def _pick(values, index_sql: str, dtype: str = "string") -> str:
    """SQL: item ``index`` (1-based) of a fixed list; NULL outside the list."""
    return f"try_element_at(array({_sql_list(values)}), CAST({index_sql} AS INT))" + (
        f"::{dtype}" if dtype != "string" else "")


def _bands(value_sql: str, bands) -> str:
    """SQL: first band (upper bound inclusive, label) containing the value."""
    return "CASE " + " ".join(f"WHEN {value_sql} <= {u} THEN '{label}'" for u, label in bands) + " END"


# Each column is one SQL expression string: a single parse per column keeps
# plan construction cheap (the expressions run JVM-side either way).
def users_from_customer(customer: DataFrame) -> DataFrame:
    k = "c_custkey"
    return customer.selectExpr(
        f"CAST({k} AS STRING) AS user_id",
        f"concat('u', CAST(CASE WHEN {k} % 33 = 1 THEN {k} - 1 ELSE {k} END AS STRING), '@example.com') AS email",
        "c_name AS username",
        f"{_pick(COUNTRIES, 'c_nationkey + 1')} AS country",
        f"TIMESTAMP_NTZ'2023-01-01 00:00:00' + make_dt_interval(CAST(({k} * 131) % 1000 AS INT), 0, 0, "
        f"CAST(({k} * 7919) % 86400 AS INT)) AS signup_date",
        f"CAST(CASE WHEN {k} % 20 = 0 THEN {_pick(INVALID_BIRTH_YEARS, f'(floor({k} / 20) % 5) + 1', 'int')} "
        f"ELSE 1960 + ({k} * 17) % 46 END AS INT) AS birth_year")


_CTYPE = _pick(["movie", "series", "documentary", "short"], "(p_partkey % 4) + 1")


def content_from_part(part: DataFrame) -> DataFrame:
    x = "(p_partkey * 37)"
    original = "((p_partkey * 3) % 10 < 3)"
    return part.selectExpr(
        "CAST(p_partkey AS STRING) AS content_id",
        "concat_ws(' ', p_name, CAST(p_partkey AS STRING)) AS title",
        f"{_CTYPE} AS content_type",
        f"{_pick(GENRES, '(p_partkey * 7) % 15 + 1')} AS genre",
        "CAST(2015 + p_partkey % 11 AS INT) AS release_year",
        f"CAST(CASE p_partkey % 4 WHEN 0 THEN 80 + {x} % 101 WHEN 1 THEN 25 + {x} % 36 "
        f"WHEN 2 THEN 45 + {x} % 76 ELSE 5 + {x} % 21 END AS INT) AS duration_minutes",
        f"{_pick(RATINGS, 'p_partkey % 8 + 1')} AS rating",
        f"{original} AS is_original",
        f"CAST(CASE WHEN p_partkey % 25 = 0 THEN NULL WHEN {original} "
        f"THEN 500000 + (p_partkey * p_partkey * 1237) % 49500001 "
        f"ELSE 10000 + (p_partkey * 7919) % 1990001 END AS DECIMAL(12,2)) AS production_cost_usd")


def subscriptions_from_orders(orders: DataFrame) -> DataFrame:
    k = "o_orderkey"
    plan = ("CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'premium' WHEN '2' THEN 'standard' "
            "WHEN '3' THEN 'standard' WHEN '4' THEN 'basic' ELSE 'free_trial' END")
    status = (f"CASE WHEN o_orderstatus = 'O' THEN 'active' WHEN o_orderstatus = 'P' THEN 'cancelled' "
              f"WHEN {k} % 3 = 0 THEN 'paused' ELSE 'expired' END")
    price = ("CAST(CASE plan_type " + " ".join(f"WHEN '{p}' THEN {v}" for p, v in PLAN_PRICES.items())
             + " END AS DECIMAL(6,2))")
    return (orders.selectExpr(f"CAST({k} AS STRING) AS subscription_id", "CAST(o_custkey AS STRING) AS user_id",
                              f"{plan} AS plan_type", f"{status} AS status",
                              f"date_add(to_date(o_orderdate), {DAY_SHIFT}) AS start_date", f"{k} AS _k")
            .selectExpr("subscription_id", "user_id", "plan_type", "status", "start_date",
                        "CASE WHEN status = 'active' THEN CAST(NULL AS DATE) "
                        "ELSE date_add(start_date, CAST(14 + (_k * 53) % 352 AS INT)) END AS end_date",
                        f"{price} AS monthly_price"))


def events_from_lineitem(lineitem: DataFrame, orders: DataFrame, content: DataFrame) -> DataFrame:
    """Viewing events: one per line item of an order. The content lookup
    (duration) is a left join on the derived title key; Spark picks a
    broadcast only when AQE measures the catalogue below the threshold."""
    o = orders.select("o_orderkey", "o_custkey")
    durations = content.select(F.col("content_id").alias("_cid"), "duration_minutes")
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_shipdate")
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
         .withColumn("content_id", F.col("l_partkey").cast("string"))
         .join(durations, F.col("content_id") == F.col("_cid"), "left"))
    etype = _bands("((l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber * 3) % 20)",
                   [(7, "play"), (10, "pause"), (13, "resume"), (17, "complete"), (19, "abandon")])
    device = _bands("((l_partkey * 13 + l_suppkey * 11 + l_linenumber) % 20)",
                    [(5, "smart_tv"), (11, "mobile"), (14, "tablet"), (17, "desktop"), (19, "console")])
    step1 = j.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "o_custkey", "content_id",
        "duration_minutes", "CAST(floor(l_quantity) AS BIGINT) AS qty", f"{etype} AS event_type",
        f"{device} AS device_type")
    kk = "(qty * 7 + l_linenumber)"
    percent = (f"CASE event_type WHEN 'play' THEN 5 + {kk} % 76 WHEN 'pause' THEN 3 + {kk} % 48 "
               f"WHEN 'resume' THEN 3 + {kk} % 48 WHEN 'complete' THEN 100 ELSE 1 + {kk} % 30 END")
    hour = "CASE WHEN l_orderkey % 5 < 3 THEN 18 + l_partkey % 6 ELSE l_partkey % 24 END"
    return step1.selectExpr(
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), "
        "CAST(l_suppkey AS STRING), CAST(qty AS STRING), date_format(l_shipdate, 'yyyyMMdd')) AS event_id",
        "CAST(o_custkey AS STRING) AS user_id", "content_id", "event_type", "device_type",
        f"CAST(greatest(CAST(1 AS BIGINT), floor(duration_minutes * 60 * ({percent}) / 100)) AS INT) "
        "AS watch_duration_sec",
        f"CAST(l_shipdate AS TIMESTAMP_NTZ) + make_dt_interval({DAY_SHIFT}, CAST({hour} AS INT), "
        "CAST((l_suppkey * 7 + l_linenumber) % 60 AS INT), CAST(l_orderkey % 60 AS INT)) AS event_timestamp")


@dataclass
class RawTables:
    users: DataFrame
    subscriptions: DataFrame
    content: DataFrame
    viewing_events: DataFrame


class LazyRawTables:
    """The four raw tables over the test Parquet, each planned on first use
    (a query that needs only subscriptions never reads lineitem)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _read(self, name, cols):
        return read_table(self.spark, self.sf_dir, name, cols)

    @cached_property
    def _orders(self) -> DataFrame:
        return self._read("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                     "o_orderpriority"])

    @cached_property
    def users(self) -> DataFrame:
        return users_from_customer(self._read("customer", ["c_custkey", "c_name", "c_nationkey"]))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return subscriptions_from_orders(self._orders)

    @cached_property
    def content(self) -> DataFrame:
        return content_from_part(self._read("part", ["p_partkey", "p_name"]))

    @cached_property
    def viewing_events(self) -> DataFrame:
        return events_from_lineitem(self._read("lineitem", None), self._orders, self.content)


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyRawTables:
    return LazyRawTables(spark, sf_dir)
