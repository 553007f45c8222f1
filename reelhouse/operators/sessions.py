"""Gap and session operators over an event log.

A plain ``Window.partitionBy(user)`` sorts all of one user's events in one
task; with one user holding a third of the log that task holds a third of
the data. Here the per-event windows are partitioned by (key, day), and only
the first event of each day meets the other days of its key:

1. the (key, day) window numbers a day's events and gives each but the first
   its previous time; its rows are stored once, as they are read twice;
2. the days' first events, one row per active day even of a very busy key, take
   the previous active day's last time by ``lag`` over the key, and the number
   of sessions begun on earlier days by a running sum;
3. the other events have their gap from step 1. For session numbers they are
   joined with the first event of their day; days of one event are not in that
   join.

A NULL key is a key like any other: its events get gaps and session numbers.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import wall_micros
from .stored import store


def _seconds_between(a, b):
    """Whole seconds from a to b (b >= a; fractions truncated). Computed on
    the wall-clock values, so no session time zone or DST shift enters."""
    return F.floor((wall_micros(b) - wall_micros(a)) / F.lit(1000000)).cast("bigint")


def _in_days(df: DataFrame, key: str, ts: str, tiebreak: str, out: str, gap_seconds: int | None) -> DataFrame:
    """Adds the day, the previous time and gap within it, the event's place and
    the day's number of events and last time; with ``gap_seconds`` also the
    sessions begun after the day's first event, so far (``_in_day``) and in all
    (``_later``). Stored."""
    day = Window.partitionBy(key, "_day")
    ordered = day.orderBy(F.col(ts), F.col(tiebreak))
    d = df.withColumn("_day", F.to_date(F.col(ts)))
    d = d.withColumns({"prev_" + ts: F.lag(F.col(ts)).over(ordered), "_place": F.row_number().over(ordered)})
    d = d.withColumn(out, _seconds_between(F.col("prev_" + ts), F.col(ts)))
    last = {"_last": F.max(F.col(ts)).over(day), "_rows": F.count(F.lit(1)).over(day)}
    if gap_seconds is None:
        return store(d.withColumns(last), "gaps")
    # an event without a time has no gap and begins a session, as the first one
    starts = F.when(F.col("_place") > 1, (F.col(out).isNull() | (F.col(out) > F.lit(gap_seconds))).cast("int")).otherwise(0)
    d = d.withColumn("_starts", starts)
    return store(d.withColumns(last | {
        "_in_day": F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
        "_later": F.sum("_starts").over(day)}).drop("_starts"), "sessions")


def _first_events(d: DataFrame, key: str, ts: str, out: str) -> DataFrame:
    """The days' first events with the time of the key's event before."""
    w = Window.partitionBy(key).orderBy("_day")
    first = d.where("_place = 1").withColumn("prev_" + ts, F.lag("_last").over(w))
    return first.withColumn(out, _seconds_between(F.col("prev_" + ts), F.col(ts)))


def with_gap(df: DataFrame, key: str, ts: str, tiebreak: str, out: str = "gap_sec") -> DataFrame:
    """Adds ``prev_<ts>`` (the same key's previous event time, NULL first)
    and ``out`` = whole seconds since it. Making the plan runs a job."""
    d = _in_days(df, key, ts, tiebreak, out, None)
    return d.where("_place > 1").unionByName(_first_events(d, key, ts, out)).select(
        *[F.col(f"`{c}`") for c in df.columns], "_day", "prev_" + ts, out)


def sessionize(df: DataFrame, key: str, ts: str, tiebreak: str, gap_seconds: int) -> DataFrame:
    """A session starts at a key's first event and after a gap strictly
    longer than ``gap_seconds``. Adds gap_sec, is_new_session, session_no
    (1-based per key) and session_id ('key#n'). Making the plan runs a job."""
    d = _in_days(df, key, ts, tiebreak, "gap_sec", gap_seconds)
    new = F.col("gap_sec").isNull() | (F.col("gap_sec") > F.lit(gap_seconds))
    earlier = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    first = _first_events(d, key, ts, "gap_sec").withColumn("_new", new.cast("int"))
    first = first.withColumn("_before", F.coalesce(F.sum(F.col("_new") + F.col("_later")).over(earlier), F.lit(0)) + F.col("_new"))
    # NULL keys and days meet their own first event
    days = first.where("_rows > 1").select(F.col(key).alias("_k"), F.col("_day").alias("_d"), "_before")
    others = d.where("_place > 1").join(
        days, F.col(key).eqNullSafe(F.col("_k")) & F.col("_day").eqNullSafe(F.col("_d"))).drop("_k", "_d")
    g = first.drop("_new").unionByName(others)
    g = g.withColumn("session_no", (F.col("_before") + F.col("_in_day")).cast("int"))
    return g.select(
        *[F.col(f"`{c}`") for c in df.columns], "prev_" + ts, "gap_sec", new.alias("is_new_session"), "session_no",
        F.concat_ws("#", F.col(key).cast("string"), F.col("session_no").cast("string")).alias("session_id"))
