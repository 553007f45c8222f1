"""Distributed operators against plain (single-task) forms."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import same_rows
from reelhouse.operators.overlap import active_by_month, active_by_month_explode
from reelhouse.operators.prefix import group_quantiles, ordered_prefix_sums
from reelhouse.operators.rank import global_rank
from reelhouse.operators.stored import store_in_order
from reelhouse.operators.sessions import sessionize
from reelhouse.operators.similarity import block_similarity


def _ranked_fixture(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, float(rnd.randint(0, 30)), rnd.randint(0, 30) * 1.5]), f"k{rnd.randint(0, 999):04d}")
            for i in range(n)]
    rows += [(n + i, 7.0, "hot") for i in range(n // 3)]   # one hot key
    return spark.createDataFrame(rows, "id long, x double, s string")


def test_global_rank_matches_window(spark):
    df = _ranked_fixture(spark)
    for asc in (True, False):
        got = global_rank(df, "x", ascending=asc, method="rank", out="r",
                          extra={"d": "dense_rank", "p": "percent_rank"}, buckets=5)
        o = F.col("x").asc_nulls_first() if asc else F.col("x").desc_nulls_last()
        w = Window.orderBy(o)
        exp = df.select("id", "x", "s", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"),
                        F.percent_rank().over(w).alias("p"))
        ok, a, b = same_rows(got.select("id", "x", "s", "r", "d", "p").collect(), exp.collect())
        assert ok


def test_global_row_number_on_strings(spark):
    df = _ranked_fixture(spark).select("id", F.concat("s", F.col("id").cast("string")).alias("k"))
    got = global_rank(df, "k", method="row_number", out="rn", buckets=4)
    exp = df.select("id", "k", F.row_number().over(Window.orderBy("k")).alias("rn"))
    assert same_rows(got.select("id", "k", "rn").collect(), exp.collect())[0]


def test_row_number_long_prefix_repeated_keys_and_nulls(spark):
    rnd = random.Random(11)
    rows = [("Customer#0000000%05d" % rnd.randint(0, 400),) for _ in range(600)] + [("hot",)] * 300 + [(None,)] * 50
    df = spark.createDataFrame(rows, "k string")
    for asc in (True, False):
        got = [r["k"] for r in sorted(global_rank(df, "k", ascending=asc, method="row_number", out="rn",
                                                  buckets=6).collect(), key=lambda r: r["rn"])]
        want = sorted((k for k, in rows if k is not None), reverse=not asc)
        assert got == ([None] * 50 + want if asc else want + [None] * 50)
    nums = global_rank(df, "k", method="row_number", out="rn", buckets=6, total_col="n")
    assert sorted(r["rn"] for r in nums.collect()) == list(range(1, 951))
    assert nums.first()["n"] == 950
    assert global_rank(df.limit(0), "k", out="r").count() == 0
    assert global_rank(df.limit(0), "k", method="row_number", out="r").count() == 0


def test_ranges_spread_keys_with_one_prefix_and_hot_keys(spark):
    df = spark.range(5000).select(F.format_string("Customer#%012d", "id").alias("k"), F.xxhash64("id").alias("t"))
    per = [r["count"] for r in store_in_order(df, [F.col("k")], 8).groupBy("_range").count().collect()]
    assert len(per) == 8 and max(per) < 2 * 5000 / 8
    hot = df.withColumn("k", F.when(F.col("t") % 3 == 0, F.lit("Customer#000000002500")).otherwise(F.col("k")))
    per = [r["count"] for r in store_in_order(hot, [F.col("k"), F.col("t")], 8).groupBy("_range").count().collect()]
    assert len(per) == 8 and max(per) < 2 * 5000 / 8


def test_ranks_and_quantiles_read_their_input_once(wh):
    """The returned plan reads stored rows; the fact's source is read by the job that stores them."""
    from reelhouse.plans.analytics import q2_churn_segments
    from reelhouse.plans.churn import roc_auc, roc_points
    from reelhouse.plans.eda import watch_quartiles_by_risk
    from reelhouse.plans.windows import engagement_rank, event_keys
    for fn in (event_keys, engagement_rank, q2_churn_segments, watch_quartiles_by_risk, roc_points, roc_auc):
        plan = fn(wh)._jdf.queryExecution().optimizedPlan().toString()
        reads = sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines())
        assert reads == 0, (fn.__name__, reads)


def test_prefix_sums_match_running_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), rnd.randint(0, 50) / 2, rnd.randint(0, 3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, k double, w long")
    got = ordered_prefix_sums(df, "k", ["w"], ["g"], ascending=False, buckets=4)
    agg = df.groupBy("g", "k").agg(F.sum("w").alias("w"))
    exp = agg.select("g", "k", "w", F.sum("w").over(
        Window.partitionBy("g").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)).alias("cum_w"))
    assert same_rows(got.collect(), exp.collect())[0]


def test_group_quantiles_match_pandas(spark):
    import pandas as pd
    rnd = random.Random(5)
    rows = [(rnd.choice(["x", "y", "z"]), float(rnd.randint(0, 1000)) / 4) for _ in range(301)]
    rows += [("solo", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["q25"], r["q50"], r["q75"]) for r in
           group_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, part in pdf.groupby("g"):
        exp = tuple(part["v"].quantile([0.25, 0.5, 0.75]).tolist())
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[g], exp)), (g, got[g], exp)


def test_month_overlap_forms_agree(spark):
    d = dt.date
    rows = [(d(2023, 1, 1), d(2023, 1, 31)), (d(2023, 1, 31), d(2023, 2, 1)), (d(2022, 5, 5), None),
            (d(2023, 3, 20), d(2023, 3, 10)), (d(2023, 4, 20), d(2023, 2, 10)), (d(2021, 1, 1), d(2022, 1, 1)),
            (d(2024, 1, 1), d(2026, 1, 1)), (d(2023, 12, 31), None), (d(2023, 6, 30), d(2023, 7, 1))]
    df = spark.createDataFrame(rows, "start_date date, end_date date")
    months = spark.createDataFrame([(f"2023-{m:02d}",) for m in range(1, 13)] + [("2024-01",)], "ym string")
    meas = {"n": F.lit(1).cast("bigint")}
    a = active_by_month(df, "start_date", "end_date", months, meas).collect()
    b = active_by_month_explode(df, "start_date", "end_date", months, meas, "2023-01", "2024-01").collect()
    assert same_rows(a, b)[0]
    # definition, row by row
    exp = {}
    for ym, in [tuple(r) for r in months.collect()]:
        y, m = int(ym[:4]), int(ym[5:])
        first = d(y, m, 1)
        last = (d(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1))
        exp[ym] = sum(1 for s, e in rows if s <= last and (e is None or e >= first))
    assert {r["ym"]: r["n"] for r in a} == exp


def test_sessionize_matches_plain_window(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1, 22, 0, 0)
    rows = []
    for u in range(6):
        t = base
        for i in range(60 if u else 400):   # user 0 is hot
            t = t + dt.timedelta(seconds=rnd.choice([5, 60, 1800, 1801, 3600, 30000]))
            rows.append((f"e{u}-{i}", u, t))
    rows.append(("dup-a", 1, rows[70][2]))   # equal times, tie by id
    df = spark.createDataFrame(rows, "event_id string, user_id long, ts timestamp_ntz")
    got = sessionize(df, "user_id", "ts", "event_id", 1800)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    prev = F.lag("ts").over(w)
    exp = df.withColumn("gap", F.floor((F.unix_micros(F.col("ts").cast("timestamp"))
                                        - F.unix_micros(prev.cast("timestamp"))) / 1000000))
    exp = exp.withColumn("new", F.col("gap").isNull() | (F.col("gap") > 1800))
    exp = exp.withColumn("sn", F.sum(F.col("new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    a = got.select("event_id", "gap_sec", "is_new_session", "session_no").collect()
    b = exp.select("event_id", "gap", "new", "sn").collect()
    assert same_rows(a, b)[0]


def test_block_similarity_matches_self_join(spark):
    rnd = random.Random(2)
    rows = list({(f"u{rnd.randint(0, 40)}", f"c{rnd.randint(0, 15)}") for _ in range(300)})
    rows += [(f"u{i}", "hot") for i in range(41)]          # one item everybody watched
    df = spark.createDataFrame(rows, "user_id string, content_id string")
    got = block_similarity(df, blocks=3)
    n = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    a, b = df.alias("a"), df.alias("b")
    sj = (a.join(b, (F.col("a.content_id") == F.col("b.content_id")) & (F.col("a.user_id") < F.col("b.user_id")))
          .groupBy(F.col("a.user_id").alias("user_1"), F.col("b.user_id").alias("user_2"))
          .agg(F.count(F.lit(1)).alias("shared")))
    sj = (sj.join(n.withColumnRenamed("user_id", "user_1").withColumnRenamed("n", "n_1"), "user_1")
          .join(n.withColumnRenamed("user_id", "user_2").withColumnRenamed("n", "n_2"), "user_2")
          .withColumn("similarity", F.col("shared") / F.sqrt((F.col("n_1") * F.col("n_2")).cast("double"))))
    cols = ["user_1", "user_2", "shared", "n_1", "n_2", "similarity"]
    assert same_rows(got.select(*cols).collect(), sj.select(*cols).collect())[0]
    top = block_similarity(df, blocks=3, top_k=5)
    best = top.groupBy("user_1").agg(F.max("similarity").alias("m")).collect()
    full = sj.select(F.col("user_1"), "similarity").unionByName(
        sj.select(F.col("user_2").alias("user_1"), "similarity"))
    exp = {r["user_1"]: r["m"] for r in full.groupBy("user_1").agg(F.max("similarity").alias("m")).collect()}
    assert {r["user_1"]: r["m"] for r in best} == exp


def test_sessions_number_null_keys(spark):
    rows = [(None, "2024-01-01 10:00:00", "a"), (None, "2024-01-01 10:10:00", "b"), (None, "2024-01-02 09:00:00", "c"),
            ("u", "2024-01-01 23:55:00", "d"), ("u", "2024-01-02 00:05:00", "e")]
    df = spark.createDataFrame(rows, "k string, t string, id string").withColumn("t", F.to_timestamp("t"))
    got = {r.id: (r.gap_sec, r.session_no) for r in sessionize(df, "k", "t", "id", 3600).collect()}
    assert got == {"a": (None, 1), "b": (600, 1), "c": (82200, 2), "d": (None, 1), "e": (600, 1)}


def test_similarity_slices_items(spark, monkeypatch):
    import numpy as np
    import pandas as pd
    from reelhouse.operators import similarity
    monkeypatch.setattr(similarity, "ITEM_SLICE", 3)
    left = pd.Series([["a", "b", "c", "d", "e"], ["x"], []])
    right = pd.Series([["e", "d", "z"], ["x", "a"]])
    assert np.array_equal(similarity._shared_items(left, right), [[2, 1], [0, 1], [0, 0]])


def _daily(spark, rows):
    return spark.createDataFrame(rows, "series string, full_date date, dau double")


def test_short_series_keep_a_row(spark):
    import datetime as dt
    from reelhouse.plans import forecast
    day = dt.date(2024, 1, 1)
    rows = [("s", day + dt.timedelta(i), 1.0) for i in range(12)]
    rows += [("flat", day + dt.timedelta(i), 5.0) for i in range(120)]        # no movement: nothing to fit
    forecasts, fits = forecast.forecast_series(_daily(spark, rows))
    out = forecasts.toPandas()
    short = out[out["series"] == "s"]
    assert len(short) == 12 and short["forecast"].isna().all() and short["actual"].eq(1).all()
    fit = {r["series"]: r for r in fits.collect()}
    assert fit["s"]["n_train"] == 0 and fit["s"]["aic"] is None
    assert fit["flat"]["n_train"] == 90 and fit["flat"]["ar1"] is None and fit["flat"]["mae"] is None
    assert len(out) == 42 and forecast.forecast_series(_daily(spark, []))[1].count() == 0


def test_forecast_against_least_squares(spark):
    """Coefficients, forecasts and interval against dense least squares and a
    plain loop, on a series simulated with weekly pattern and noise."""
    import datetime as dt
    import numpy as np
    from reelhouse.plans import forecast
    rand = np.random.default_rng(7)
    e, d, y = rand.normal(0, 20, 400), np.zeros(400), np.zeros(400)
    for t in range(400):
        d[t] = e[t] + (0.5 * d[t - 1] + 0.3 * e[t - 1] if t else 0) + (-0.4 * e[t - 7] if t >= 7 else 0)
        y[t] = round(d[t] + (y[t - 7] if t >= 7 else 1000))
    day = dt.date(2024, 1, 1)
    rows = [("s", day + dt.timedelta(i), float(v)) for i, v in enumerate(y)]
    forecasts, fits = forecast.forecast_series(_daily(spark, rows))

    train, test = y[:-30], y[-30:]
    w = train[7:] - train[:-7]
    def design(parts, start):
        return np.column_stack([x[start - lag:len(x) - lag] for x, lag in parts])
    first = design([(w, lag) for lag in forecast.LONG_LAGS], 14)
    c = np.linalg.lstsq(first, w[14:], rcond=None)[0]
    err = np.concatenate([np.full(14, np.nan), w[14:] - first @ c])
    second = design([(w, 1), (w, 7), (err, 1), (err, 7)], 21)
    k, *_ = np.linalg.lstsq(second, w[21:], rcond=None)
    rss, n = float(((w[21:] - second @ k) ** 2).sum()), len(w) - 21
    got = fits.first()
    assert np.allclose([got[x] for x in forecast.COEFFICIENTS], k, atol=1e-5)
    assert abs(got["ar1"] - 0.5) < 0.2 and abs(got["ma7"] + 0.4) < 0.2
    assert np.isclose(got["aic"], n * np.log(rss / n) + 8, atol=1e-3)

    hist, diffs, errs, echo, psi, want = list(train), list(w), [*err, *[0.0] * 30], [0.0] * 7, [0.0] * 7, []
    for h in range(30):
        diffs.append(k @ [diffs[-1], diffs[-7], errs[len(w) + h - 1], errs[len(w) + h - 7]])
        hist.append(diffs[-1] + hist[-7])
        echo.append(k[0] * echo[-1] + k[1] * echo[-7] + {0: 1.0, 1: k[2], 7: k[3]}.get(h, 0.0))
        psi.append(echo[-1] + psi[-7])
        half = forecast.Z95 * np.sqrt(rss / (n - 4) * np.sum(np.square(psi)))
        want.append((hist[-1], hist[-1] - half, hist[-1] + half))
    out = forecasts.orderBy("full_date").toPandas()
    assert out["actual"].tolist() == test.tolist()
    assert np.allclose(out[["forecast", "lower", "upper"]], want, atol=1e-3)
