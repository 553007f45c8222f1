"""Properties of the warehouse plans and models."""
from pyspark.sql import functions as F

from reelhouse.plans import analytics as A
from reelhouse.plans import churn as CH
from reelhouse.plans import forecast as FC
from reelhouse.plans import recommend as REC
from reelhouse.plans.warehouse import Warehouse


def test_cohort_flag_sums_equal_distinct_counts(wh):
    q = {r["cohort_month"]: r for r in A.q6_cohort_retention(wh).collect()}
    du = wh.dim_users.select("user_id", F.date_format("signup_date", "yyyy-MM").alias("c"))
    act = wh.fve.select("user_id", F.date_format("event_timestamp", "yyyy-MM").alias("a"))
    j = act.join(du, "user_id").withColumn(
        "k", (F.year(F.to_date(F.concat("a", F.lit("-01")))) * 12 + F.month(F.to_date(F.concat("a", F.lit("-01")))))
        - (F.year(F.to_date(F.concat("c", F.lit("-01")))) * 12 + F.month(F.to_date(F.concat("c", F.lit("-01"))))))
    m3 = j.filter(F.col("k") == 3).groupBy("c").agg(F.countDistinct("user_id").alias("n")).collect()
    for r in m3:
        if r["c"] in q:
            assert q[r["c"]]["m3"] == r["n"]


def test_split_keeps_classes_and_is_disjoint(wh):
    s = CH.stratified_split(wh)
    rows = s.groupBy("is_churned", "split").count().collect()
    by = {(r["is_churned"], r["split"]): r["count"] for r in rows}
    for c in (0, 1):
        n = by.get((c, "train"), 0) + by.get((c, "test"), 0)
        assert by.get((c, "test"), 0) == (n * 2 + 9) // 10
    assert s.select("user_id").distinct().count() == s.count()


def test_decomposition_adds_up(wh):
    d = FC.seasonal_decompose(wh).filter(F.col("trend").isNotNull())
    bad = d.filter(F.abs(F.col("trend") + F.col("seasonal") + F.col("resid") - F.col("observed")) > 1e-5)
    assert bad.count() == 0


def test_similarity_symmetric_in_unit_range(wh):
    s = REC.user_similarity(wh)
    assert s.filter((F.col("similarity") <= 0) | (F.col("similarity") > 1.0000001)).count() == 0
    assert s.filter(F.col("user_1") >= F.col("user_2")).count() == 0


def test_unknown_user_gets_no_recommendations(wh):
    assert REC.recommend_one(wh, user_id="no-such-user").count() == 0


def test_models_probabilities_and_determinism(wh):
    lr = CH.churn_lr(wh)
    assert lr.filter((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0
    a = sorted(CH.churn_rf(wh).select("user_id", "probability").collect())
    b = sorted(CH.churn_rf(wh).select("user_id", "probability").collect())
    assert a == b
    rep = {r["model"]: r for r in CH.model_report(wh).collect()}
    assert rep["random_forest"]["auc"] > 0.5


def test_forecast_rows_and_interval(wh):
    f = FC.dau_forecast(wh)
    assert f.filter(F.col("lower") > F.col("upper")).count() == 0
    assert f.filter(F.col("series") == "all").count() == FC.HORIZON
