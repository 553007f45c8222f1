"""Gaps and sessions against one window a key, with busy days, empty times and keys, and a read of the log only once."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import same_rows
from reelhouse.operators.sessions import sessionize, with_gap
from reelhouse.plans import windows as WIN


def test_gaps_and_sessions_of_busy_days(spark):
    rnd = random.Random(4)
    day = dt.datetime(2024, 3, 1)
    rows = [(f"e{i:04d}", rnd.choice(["hot", "hot", "a", "b", None]),
             rnd.choice([None, *[day + dt.timedelta(seconds=rnd.randrange(6 * 86400)) for _ in range(30)]])) for i in range(700)]
    df = spark.createDataFrame(rows, "id string, k string, t timestamp_ntz")
    w = Window.partitionBy("k").orderBy("t", "id")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    want = df.withColumn("prev_t", F.lag("t").over(w)).withColumn(
        "gap", F.floor((micros(F.col("t")) - micros(F.col("prev_t"))) / 1000000))
    assert same_rows(with_gap(df, "k", "t", "id", "gap").select("id", "k", "t", "prev_t", "gap").collect(),
                     want.select("id", "k", "t", "prev_t", "gap").collect())[0]
    want = want.withColumn("new", F.col("gap").isNull() | (F.col("gap") > 1800)).withColumn(
        "no", F.sum(F.col("new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = sessionize(df, "k", "t", "id", 1800)
    assert same_rows(got.select("id", "gap_sec", "is_new_session", "session_no").collect(),
                     want.select("id", "gap", "new", "no").collect())[0]


def test_events_are_joined_once(wh):
    for query in (WIN.event_gap_lag, WIN.sessions, WIN.session_summary):
        assert not any("/lineitem.parquet" in f for f in query(wh).inputFiles())
