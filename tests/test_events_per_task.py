"""The memory of one task that groups events doesn't grow with their number."""
from pyspark.sql import functions as F

from reelhouse.plans import analytics as A
from reelhouse.plans import warehouse as W
from reelhouse.sources.adapters import RawTables
from reelhouse.sources.synth import synth_tables


def _raw(spark):
    raw = synth_tables(spark, n_users=60, n_content=40, n_subs=90, n_events=3000, partitions=1)
    e = raw.viewing_events
    odd = e.limit(20).withColumn("user_id", F.lit(None).cast("string"))
    odd = odd.unionByName(e.limit(20).withColumn("content_id", F.lit(None).cast("string")))
    events = e.unionByName(e.limit(300)).unionByName(odd).coalesce(1)
    return RawTables(raw.users, raw.subscriptions, raw.content, events)


def test_tasks_follow_the_number_of_events(spark, monkeypatch):
    monkeypatch.setattr(W, "EVENTS_PER_TASK", 100, raising=False)
    wh = W.Warehouse(spark, raw=_raw(spark))
    for table in (wh.pairs, wh.user_days):
        tasks = table.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("n_events").alias("n")).collect()
        assert sum(r.n for r in tasks) == 3340
        assert max(r.n for r in tasks) <= 250, "one task groups a large part of the events"


def test_groups_and_reference_date_are_those_of_the_events(spark, monkeypatch):
    monkeypatch.setattr(W, "EVENTS_PER_TASK", 100, raising=False)
    wh = W.Warehouse(spark, raw=_raw(spark))
    events = wh.events.collect()
    for table, keys in ((wh.pairs, ("user_id", "content_id")), (wh.user_days, ("user_id", "event_date"))):
        want = {}
        for r in events:
            n, done, left, minutes = want.get(k := tuple(r[c] for c in keys), (0, 0, 0, 0))
            want[k] = n + 1, done + r.is_completed, left + r.is_abandoned, minutes + r.watch_duration_minutes
        got = table.collect()
        assert len(got) == len(want)
        assert {tuple(r[c] for c in keys): (r.n_events, r.completions, r.abandons, r.minutes) for r in got} == want
    last = spark.range(1).select(wh.as_of.alias("d")).first().d
    assert last == max(r.event_date for r in events)
    known = {r.user_id for r in wh.deduplicated_users.collect()}
    assert sum(r.users for r in A.q2_churn_segments(wh).collect()) == len(known & {r.user_id for r in events if r.content_id})
