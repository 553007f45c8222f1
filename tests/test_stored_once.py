"""Queries that pass over the events many times join the raw tables once."""
import pytest

from reelhouse.plans import churn as CH
from reelhouse.plans import forecast as FC


def reads_events(df):
    return any("/lineitem.parquet" in f for f in df.inputFiles())


@pytest.mark.parametrize("table", [CH.modelled_users, CH.split_features, CH.class_weights, CH.churn_lr])
def test_models_read_the_stored_mart(wh, table):
    assert not reads_events(table(wh))


def test_targets_have_their_users_favourites(wh):
    want = {r.user_id: (r.favorite_genre, r.region, r.current_plan) for r in wh.mart_user_engagement.collect()}
    got = CH.churn_targets(wh, threshold=0.0).collect()
    assert got and all(want[r.user_id] == (r.favorite_genre, r.region, r.current_plan) for r in got)


def test_marts_and_series_read_the_stored_events(wh):
    assert not reads_events(wh.mart_user_engagement) and not reads_events(wh.v_churn_risk_summary)
    assert not reads_events(FC.segment_series(wh))
    assert wh.events.count() == wh.fve.count()
