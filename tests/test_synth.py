"""Synthetic source: same rows for any partitioning; generator shape."""
from pyspark.sql import functions as F

from helpers import same_rows
from reelhouse.plans.warehouse import Warehouse
from reelhouse.sources.synth import synth_tables


def test_independent_of_partitions(spark):
    a = synth_tables(spark, n_users=120, n_content=40, n_subs=300, n_events=3000, partitions=1)
    b = synth_tables(spark, n_users=120, n_content=40, n_subs=300, n_events=3000, partitions=7)
    for name in ("users", "content", "subscriptions", "viewing_events"):
        assert same_rows(getattr(a, name).collect(), getattr(b, name).collect())[0], name


def test_shape_and_warehouse_build(spark):
    r = synth_tables(spark, n_users=500, n_content=200, n_subs=2000, n_events=20000)
    assert r.users.count() == 500 and r.content.count() == 200
    assert r.subscriptions.count() == 2000 and r.viewing_events.count() == 20000
    evening = r.viewing_events.filter(F.hour("event_timestamp").between(18, 23)).count() / 20000
    assert 0.6 < evening < 0.8
    heavy = r.viewing_events.groupBy("user_id").count().orderBy(F.col("count").desc()).limit(100) \
        .agg(F.sum("count")).first()[0] / 20000
    assert heavy > 0.5
    wh = Warehouse(spark, raw=r)
    assert wh.mart_user_engagement.count() == wh.dim_users.count()
    assert wh.dim_users.count() < 500          # duplicate e-mails removed
