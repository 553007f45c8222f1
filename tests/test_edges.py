"""Hand-made edge rows through the warehouse layers (FIXTURES part 3)."""
import datetime as dt
from decimal import Decimal

from reelhouse.plans import analytics as A
from reelhouse.plans.warehouse import Warehouse
from reelhouse.sources.adapters import RawTables
from reelhouse.sources.schemas import RAW_CONTENT, RAW_SUBSCRIPTIONS, RAW_USERS, RAW_VIEWING_EVENTS


def _wh(spark):
    T = dt.datetime
    users = [("u1", "a@x", "one", "USA", T(2023, 1, 5, 10), 1980),
             ("u2", "a@x", "two", "GBR", T(2023, 1, 5, 10), 1929),   # same e-mail, same time: u1 wins
             ("u3", "b@x", "three", None, T(2023, 2, 1), None),
             ("u4", "b@x", "four", "JPN", T(2023, 1, 1), 2011),        # earlier signup wins
             ("u5", "c@x", "five", "ZZZ", T(2023, 3, 1), 2006)]        # no events
    subs = [("s1", "u1", "basic", "expired", dt.date(2023, 2, 1), dt.date(2023, 3, 1), Decimal("7.99")),
            ("s2", "u1", "premium", "active", dt.date(2023, 2, 1), None, Decimal("19.99")),  # tie on date: s2
            ("s3", "u4", "free_trial", "cancelled", dt.date(2023, 5, 1), dt.date(2023, 4, 1), Decimal("0.00"))]
    content = [("c1", "Alpha", "movie", "Drama", 2020, 91, "R", True, None),
               ("c2", "Beta", "short", "Comedy", 2019, 15, None, False, Decimal("0.00")),
               ("c3", "Gamma", "series", "Drama", 2021, 45, "PG", True, Decimal("10000000.00"))]
    ev = [("e1", "u1", "c1", "play", "mobile", 600, T(2024, 1, 1, 23, 50)),
          ("e2", "u1", "c2", "pause", "mobile", 60, T(2024, 1, 2, 0, 10)),
          ("e3", "u1", "c3", "complete", "smart_tv", 2700, T(2024, 1, 2, 0, 40, 1)),
          ("e4", "u4", "c3", "abandon", "console", 30, T(2023, 12, 1, 6)),
          ("e5", "u9", "c1", "resume", "tablet", 1, T(2023, 11, 30, 12))]  # user not in users
    return Warehouse(spark, raw=RawTables(
        users=spark.createDataFrame(users, RAW_USERS), subscriptions=spark.createDataFrame(subs, RAW_SUBSCRIPTIONS),
        content=spark.createDataFrame(content, RAW_CONTENT), viewing_events=spark.createDataFrame(ev, RAW_VIEWING_EVENTS)))


def test_dim_users_edges(spark):
    wh = _wh(spark)
    d = {r["user_id"]: r for r in wh.dim_users.collect()}
    assert set(d) == {"u1", "u4", "u5"}
    assert d["u1"]["current_plan_type"] == "premium" and d["u1"]["age_group"] == "45-59"
    assert d["u4"]["birth_year"] is None and d["u4"]["age_group"] == "Unknown"
    assert d["u4"]["current_plan_status"] == "cancelled"
    assert d["u5"]["region"] == "Other" and d["u5"]["age_group"] == "Under 18"
    assert d["u1"]["days_since_signup"] == (dt.date(2024, 1, 2) - dt.date(2023, 1, 5)).days


def test_content_and_marts_edges(spark):
    wh = _wh(spark)
    c = {r["content_id"]: r for r in wh.mart_content_performance.collect()}
    assert c["c1"]["cost_tier"] is None and c["c1"]["views_per_dollar"] is None
    assert c["c2"]["cost_tier"] == "low" and c["c2"]["views_per_dollar"] is None    # zero cost
    assert c["c3"]["cost_tier"] == "premium" and c["c1"]["duration_bucket"] == "feature"
    assert c["c2"]["duration_bucket"] == "short" and c["c3"]["duration_bucket"] == "medium"
    assert c["c1"]["completion_rate"] is None           # no completes or abandons
    assert c["c1"]["popularity_rank"] == 1 and c["c3"]["popularity_rank"] == 1 and c["c2"]["popularity_rank"] == 3
    m = {r["user_id"]: r for r in wh.mart_user_engagement.collect()}
    assert m["u5"]["churn_risk"] == "new" and m["u5"]["total_watch_events"] == 0
    assert m["u1"]["churn_risk"] == "low" and m["u1"]["distinct_days_active"] == 2
    assert m["u4"]["days_since_last_watch"] == 32 and m["u4"]["churn_risk"] == "high"
    assert m["u1"]["favorite_device"] == "mobile"


def test_sessions_and_subscriptions_edges(spark):
    wh = _wh(spark)
    from reelhouse.plans.windows import sessions
    s = {r["event_id"]: r for r in sessions(wh).collect()}
    assert s["e2"]["gap_sec"] == 1200 and not s["e2"]["is_new_session"]     # across midnight
    assert s["e3"]["gap_sec"] == 1801 and s["e3"]["is_new_session"] and s["e3"]["session_no"] == 2
    f = {r["subscription_id"]: r for r in wh.fact_subscriptions.collect()}
    assert f["s2"]["duration_days"] is None and f["s3"]["estimated_ltv"] is None
    assert f["s1"]["estimated_ltv"] == Decimal("7.35")     # 7.99 * round(28 / 30.44, 4)
    q = {r["ym"]: r for r in wh.mart_subscription_metrics.collect()}
    assert q["2023-02"]["total_active"] == 2 and q["2023-03"]["total_active"] == 2
    assert q["2023-04"]["total_active"] == 1 and q["2023-05"]["active_free_trial"] == 0   # ends before start
    assert A.q7_original_roi(wh).count() == 0    # no original has 10+ views
