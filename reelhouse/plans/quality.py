"""Data quality: the staging constraints (keys, foreign keys, NOT NULL,
value lists, text widths) re-expressed as queries, plus layer row counts."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import same_text
from ..operators.cascade import cascade
from ..sources.schemas import (CONTENT_TYPES, DEVICE_TYPES, EVENT_TYPES, MAX_LENGTHS, PLAN_TYPES,
                               RAW_SCHEMAS, SUB_STATUSES)
from .warehouse import Warehouse


def _raw(wh: Warehouse) -> dict[str, DataFrame]:
    r = wh.raw
    return {"raw_users": r.users, "raw_subscriptions": r.subscriptions, "raw_content": r.content,
            "raw_viewing_events": r.viewing_events}


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


UNIQUE_KEYS = [("raw_users", "user_id"), ("raw_users", "email"),
               ("raw_subscriptions", "subscription_id"), ("raw_content", "content_id"),
               ("raw_viewing_events", "event_id")]


def dq_duplicates(wh: Warehouse) -> DataFrame:
    """Per declared key: keys seen more than once and the rows they cover."""
    raw = _raw(wh)
    out = []
    for table, col in UNIQUE_KEYS:
        key = same_text(col) if col == "email" else col
        c = raw[table].groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        out.append(c.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                         F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"))
                   .select(F.lit(table).alias("table_name"), F.lit(col).alias("key_column"),
                           "duplicate_keys", "duplicate_rows"))
    return _union(out)


FOREIGN_KEYS = [("raw_subscriptions", "user_id", "raw_users", "user_id"),
                ("raw_viewing_events", "user_id", "raw_users", "user_id"),
                ("raw_viewing_events", "content_id", "raw_content", "content_id")]


def dq_orphans(wh: Warehouse) -> DataFrame:
    """Child rows whose parent key is missing (anti join per foreign key)."""
    raw = _raw(wh)
    out = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        parents = raw[parent].select(F.col(pcol).alias("_pk"))
        orphans = raw[child].join(parents, F.col(ccol) == F.col("_pk"), "left_anti")
        out.append(orphans.agg(F.count(F.lit(1)).alias("orphan_rows")).select(
            F.lit(child).alias("child_table"), F.lit(ccol).alias("child_column"),
            F.lit(parent).alias("parent_table"), "orphan_rows"))
    return _union(out)


def after_delete(wh: Warehouse) -> dict[str, DataFrame]:
    """The raw tables without the users that have no country and without all
    rows that refer to them."""
    return cascade(_raw(wh), FOREIGN_KEYS, {"raw_users": F.col("country").isNull()})


def users_after_delete(wh: Warehouse) -> DataFrame:
    return after_delete(wh)["raw_users"]


def subscriptions_after_delete(wh: Warehouse) -> DataFrame:
    return after_delete(wh)["raw_subscriptions"]


def viewing_events_after_delete(wh: Warehouse) -> DataFrame:
    return after_delete(wh)["raw_viewing_events"]


def cascade_delete(wh: Warehouse) -> DataFrame:
    """Delete users without a country and cascade to their subscriptions and
    events; report rows before and after per table."""
    raw, after = _raw(wh), after_delete(wh)
    out = []
    for t in ("raw_users", "raw_subscriptions", "raw_viewing_events"):
        after_n = after[t].agg(F.count(F.lit(1))).scalar()
        out.append(raw[t].agg(F.count(F.lit(1)).alias("rows_before")).select(
            F.lit(t).alias("table_name"), "rows_before", after_n.alias("rows_after")))
    return _union(out)


def dq_nulls(wh: Warehouse) -> DataFrame:
    """NULLs per column of each raw table (nullable columns included)."""
    raw = _raw(wh)
    out = []
    for t, schema in RAW_SCHEMAS.items():
        df = raw[t]
        aggs = [F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields]
        wide = df.agg(*aggs)
        stack = ", ".join(f"'{f.name}', `{f.name}`, {str(not f.nullable).lower()}"
                          for f in schema.fields)
        out.append(wide.select(F.lit(t).alias("table_name"), F.expr(
            f"stack({len(schema.fields)}, {stack}) AS (column_name, null_rows, required)")))
    return _union(out)


DOMAINS = [("raw_subscriptions", "plan_type", PLAN_TYPES), ("raw_subscriptions", "status", SUB_STATUSES),
           ("raw_content", "content_type", CONTENT_TYPES), ("raw_viewing_events", "event_type", EVENT_TYPES),
           ("raw_viewing_events", "device_type", DEVICE_TYPES)]


def dq_domains(wh: Warehouse) -> DataFrame:
    """Values outside each column's list, and texts longer than declared."""
    raw = _raw(wh)
    rules = [(t, c, "domain", ~F.col(c).isin(*values)) for t, c, values in DOMAINS]
    rules += [(t, c, f"length<={n}", F.length(c) > n) for t, widths in MAX_LENGTHS.items()
              for c, n in widths.items()]
    out = []
    for table in dict.fromkeys(t for t, _, _, _ in rules):      # one scan per table
        mine = [(c, check, broken) for t, c, check, broken in rules if t == table]
        wide = raw[table].agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(mine)])
        stack = ", ".join(f"'{c}', '{check}', _{i}" for i, (c, check, _) in enumerate(mine))
        out.append(wide.select(F.lit(table).alias("table_name"), F.expr(
            f"stack({len(mine)}, {stack}) AS (column_name, check_name, violations)")))
    return _union(out)


def dq_dirty_users(wh: Warehouse) -> DataFrame:
    """Dirty-row profile of raw users: duplicate e-mail rows and each
    invalid birth year (outside 1930..2010, NULL included)."""
    u = wh.raw.users
    dup = u.groupBy(same_text("email")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1) \
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows")) \
        .select(F.lit("duplicate_email").alias("issue"), F.lit(None).cast("string").alias("value"), "rows")
    bad = u.filter(~F.coalesce(F.col("birth_year").between(1930, 2010), F.lit(False))) \
        .groupBy(F.col("birth_year").cast("string").alias("value")) \
        .agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("invalid_birth_year").alias("issue"), "value", "rows")
    return dup.unionByName(bad)


def layer_row_counts(wh: Warehouse) -> DataFrame:
    """Row count of every table of the three layers (UNION ALL of counts)."""
    tables = {
        "raw_users": wh.raw.users, "raw_subscriptions": wh.raw.subscriptions,
        "raw_content": wh.raw.content, "raw_viewing_events": wh.raw.viewing_events,
        "dim_date": wh.dim_date, "dim_device": wh.dim_device, "dim_users": wh.dim_users,
        "dim_content": wh.dim_content, "fact_viewing_events": wh.fact_viewing_events,
        "fact_subscriptions": wh.fact_subscriptions,
        "mart_user_engagement": wh.mart_user_engagement.select("user_id"),
        "mart_content_performance": wh.mart_content_performance.select("content_id"),
        "mart_subscription_metrics": wh.mart_subscription_metrics.select("ym"),
    }
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(t).alias("table_name"), "row_count") for t, df in tables.items()])
