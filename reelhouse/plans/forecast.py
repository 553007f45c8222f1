"""Daily-active-user series: decomposition, seasonal-naive baseline and a
seasonal ARMA model fitted per series.

The notebook's single seasonal model is re-aimed to many series at once (all
users, each device, region and genre). Its autoregressive and moving-average
terms at lags 1 and 7 are fitted on seasonal differences by two regressions,
whose normal equations are Spark aggregates of one row a series. A series has
one row per day, so its windows are bounded by the calendar, never by the
event volume.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.stored import store
from .eda import dau_series
from .warehouse import Warehouse

PERIOD = 7
HORIZON = 30
Z95 = 1.959963984540054


def seasonal_decompose(wh: Warehouse) -> DataFrame:
    """Additive decomposition with period 7: centred 7-day mean as trend
    (NULL on the three edge days each side), phase means of the detrended
    series centred to sum zero as seasonal, the rest as residual."""
    s = dau_series(wh)
    first = s.agg(F.min("full_date")).scalar()
    w = Window.orderBy("full_date").rowsBetween(-3, 3)
    s = s.withColumn("phase", F.pmod(F.datediff("full_date", first), F.lit(PERIOD))) \
        .withColumn("trend", F.when(F.count(F.lit(1)).over(w) == PERIOD, F.avg("dau").over(w)))
    phase = s.groupBy("phase").agg(F.avg(F.col("dau") - F.col("trend")).alias("_pm"))
    centre = phase.agg(F.avg("_pm")).scalar()
    phase = phase.withColumn("seasonal", F.col("_pm") - centre).drop("_pm")
    j = s.join(F.broadcast(phase), "phase")   # 7 rows
    return j.select("full_date", F.col("dau").alias("observed"), F.round("trend", 6).alias("trend"),
                    F.round("seasonal", 6).alias("seasonal"),
                    F.round(F.col("dau") - F.col("trend") - F.col("seasonal"), 6).alias("resid"))


def dau_forecast_naive(wh: Warehouse, horizon: int = HORIZON) -> DataFrame:
    """Seasonal-naive forecast of the last ``horizon`` days: the value of the
    same weekday in the last training week."""
    s = dau_series(wh)
    last_train = F.date_sub(s.agg(F.max("full_date")).scalar(), horizon)
    test = s.filter(F.col("full_date") > last_train)
    h = F.datediff("full_date", last_train)
    test = test.withColumn("_src", F.date_add(last_train, (F.pmod(h - 1, F.lit(PERIOD)) - (PERIOD - 1)).cast("int")))
    src = s.select(F.col("full_date").alias("_src"), F.col("dau").alias("forecast"))
    return test.join(src, "_src").select("full_date", F.col("dau").alias("actual"), "forecast")


def forecast_metrics(wh: Warehouse) -> DataFrame:
    """MAE, RMSE and MAPE (zero actuals skipped) of the seasonal-naive forecast."""
    f = dau_forecast_naive(wh)
    err = F.col("actual") - F.col("forecast")
    return f.agg(F.count(F.lit(1)).alias("days"),
                 F.round(F.avg(F.abs(err)), 6).alias("mae"),
                 F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"),
                 F.round(F.avg(F.when(F.col("actual") != 0, F.abs(err) / F.col("actual"))) * 100, 6)
                 .alias("mape"))


# ---- many-series seasonal model -------------------------------------------------------
def segment_series(wh: Warehouse) -> DataFrame:
    """(series, full_date, dau) for all users, each device, region and genre,
    gap-filled with 0 between each series' first and last day."""
    f = wh.events
    by_device = f.groupBy("device_type", "event_date").agg(F.countDistinct("user_id").alias("dau")) \
        .select(F.concat(F.lit("device:"), F.col("device_type")).alias("series"), "event_date", "dau")
    regions = wh.dim_users.select("user_id", "region")
    by_region = wh.user_days.join(regions, "user_id").groupBy("region", "event_date") \
        .agg(F.count(F.lit(1)).alias("dau")) \
        .select(F.concat(F.lit("region:"), F.col("region")).alias("series"), "event_date", "dau")
    genres = wh.dim_content.select("content_id", "genre")
    by_genre = f.join(genres, "content_id").groupBy("genre", "event_date") \
        .agg(F.countDistinct("user_id").alias("dau")) \
        .select(F.concat(F.lit("genre:"), F.col("genre")).alias("series"), "event_date", "dau")
    total = wh.daily_fact.select(F.lit("all").alias("series"), "event_date", "dau")
    d = total.unionByName(by_device).unionByName(by_region).unionByName(by_genre)
    span = d.groupBy("series").agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    cal = span.select("series", F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("event_date"))
    return cal.join(d, ["series", "event_date"], "left").select(
        "series", F.col("event_date").alias("full_date"), F.coalesce("dau", F.lit(0)).cast("double").alias("dau"))


#: Lags of the long autoregression; lags of the differences and of its residuals in the model.
LONG_LAGS, AR_LAGS, MA_LAGS = (1, 2, 3, 7, 14), (1, 7), (1, 7)
COEFFICIENTS = ["ar1", "ar7", "ma1", "ma7"]
#: Shortest training part that is fitted, and the share of a diagonal entry under which a pivot counts as zero.
MIN_TRAIN, TINY = 56, 1e-9


def _lagged(df: DataFrame, column: str, lags: tuple[int, ...]) -> DataFrame:
    """Columns ``<column>_<lag>``; the windows hold one series, a row a day."""
    w = Window.partitionBy("series").orderBy("pos")
    return df.withColumns({f"{column}_{lag}": F.lag(column, lag).over(w) for lag in lags})


def _normal_equations(df: DataFrame, xs: list[str], y: str) -> DataFrame:
    """Per series the sums of products g<i>_<j> and b<i>, ``yy`` and ``rows``
    over the days that have all regressors."""
    p = range(len(xs))
    full = df.dropna(subset=[*xs, y])
    return full.groupBy("series").agg(
        *[F.sum(F.col(xs[i]) * F.col(xs[j])).alias(f"g{i}_{j}") for i in p for j in p if i <= j],
        *[F.sum(F.col(xs[i]) * F.col(y)).alias(f"b{i}") for i in p],
        F.sum(F.col(y) * F.col(y)).alias("yy"), F.count(F.lit(1)).alias("rows"))


def _solve(sums: DataFrame, names: list[str]) -> DataFrame:
    """Solves each row's symmetric equations by elimination, a projection a
    step: columns ``names``, ``rss`` and ``rows``. NULL where the regressors
    depend on each other."""
    p = range(len(names))
    df = sums.withColumns({f"d{i}": F.col(f"g{i}_{i}") for i in p} | {f"r{i}": F.col(f"b{i}") for i in p})
    for k in p:
        pivot = F.when(F.col(f"g{k}_{k}") > TINY * F.col(f"d{k}"), F.col(f"g{k}_{k}"))
        factor = {i: F.col(f"g{k}_{i}") / pivot for i in p if i > k}
        df = df.withColumns({f"g{k}_{k}": pivot}
                            | {f"g{i}_{j}": F.col(f"g{i}_{j}") - f * F.col(f"g{k}_{j}") for i, f in factor.items()
                               for j in p if j >= i}
                            | {f"b{i}": F.col(f"b{i}") - f * F.col(f"b{k}") for i, f in factor.items()})
    for i in reversed(p):
        known = sum((F.col(f"g{i}_{j}") * F.col(names[j]) for j in p if j > i), F.lit(0.0))
        df = df.withColumn(names[i], (F.col(f"b{i}") - known) / F.col(f"g{i}_{i}"))
    left = F.col("yy") - sum((F.col(names[i]) * F.col(f"r{i}") for i in p), F.lit(0.0))
    rss = F.when(left.isNull(), None).when(left > TINY * F.col("yy"), left).otherwise(0.0)
    return df.select("series", *names, rss.alias("rss"), "rows")


def _positions(series: DataFrame) -> DataFrame:
    """Days numbered within their series, with the length of its training part
    (all but the last 30 days) and the difference to the day a week before."""
    by_series = Window.partitionBy("series")
    df = series.withColumns({
        "pos": F.row_number().over(by_series.orderBy("full_date")),
        "n_train": F.greatest(F.count(F.lit(1)).over(by_series) - HORIZON, F.lit(0))})
    return df.withColumn("diff", F.col("dau") - F.lag("dau", PERIOD).over(by_series.orderBy("full_date")))


def fit_series(days: DataFrame) -> DataFrame:
    """The model of every series, from ``_positions``: ``COEFFICIENTS``,
    ``rss``, ``rows``, and ``last``, its last week of (pos, dau, diff, error).

    Seasonal differences d follow d = ar1 d[-1] + ar7 d[-7] + e + ma1 e[-1] +
    ma7 e[-7], fitted by two regressions: a long autoregression gives the
    errors e, which are regressors of the second one. Series with less than
    ``MIN_TRAIN`` training days, or without movement, have no coefficients."""
    train = days.filter((F.col("n_train") >= MIN_TRAIN) & (F.col("pos") <= F.col("n_train")))
    train = _lagged(train, "diff", LONG_LAGS)
    long_terms = [f"diff_{lag}" for lag in LONG_LAGS]
    weights = [f"c{lag}" for lag in LONG_LAGS]
    first = _solve(_normal_equations(train, long_terms, "diff"), weights).select("series", *weights)
    fitted = sum((F.col(c) * F.col(x) for c, x in zip(weights, long_terms, strict=True)), F.lit(0.0))
    train = train.join(first, "series").withColumn("error", F.col("diff") - fitted)
    train = _lagged(train, "error", MA_LAGS)
    terms = [f"diff_{lag}" for lag in AR_LAGS] + [f"error_{lag}" for lag in MA_LAGS]
    second = _solve(_normal_equations(train, terms, "diff"), COEFFICIENTS)
    week = F.struct("pos", "dau", "diff", "error")
    last = train.groupBy("series").agg(F.sort_array(F.collect_list(
        F.when(F.col("pos") > F.col("n_train") - PERIOD, week))).alias("last"))
    return second.join(last, "series")


def _paths(fits: DataFrame) -> DataFrame:
    """Per series the forecasts of the next 30 days and their standard errors,
    by recursion over arrays of a week and a month."""
    ar1, ar7, ma1, ma7 = (F.col(c) for c in COEFFICIENTS)
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    back = lambda a, lag: F.element_at(a, F.lit(-lag))
    steps = F.sequence(F.lit(1), F.lit(HORIZON))
    push = lambda a, x: F.concat(a, F.array(x))
    df = fits.withColumns({
        "sigma": F.when(F.col("rows") > len(COEFFICIENTS), F.sqrt(F.col("rss") / (F.col("rows") - len(COEFFICIENTS)))),
        "errors": F.concat(F.col("last.error"), zeros(HORIZON))})
    df = df.withColumn("diffs", F.aggregate(steps, F.col("last.diff"), lambda a, h: push(
        a, ar1 * back(a, 1) + ar7 * back(a, PERIOD) + ma1 * F.element_at("errors", h + PERIOD - 1)
        + ma7 * F.element_at("errors", h))))
    df = df.withColumn("path", F.aggregate(steps, F.col("last.dau"), lambda a, h: push(
        a, F.element_at("diffs", h + PERIOD) + back(a, PERIOD))))
    # effect of one error after h - 1 days: on the differences, then on the days
    shock = lambda h, lag, x: F.when(h == 1 + lag, x).otherwise(0.0)
    df = df.withColumn("echo", F.aggregate(steps, zeros(PERIOD), lambda a, h: push(
        a, ar1 * back(a, 1) + ar7 * back(a, PERIOD) + shock(h, 0, F.lit(1.0)) + shock(h, 1, ma1) + shock(h, PERIOD, ma7))))
    df = df.withColumn("psi", F.aggregate(steps, zeros(PERIOD), lambda a, h: push(
        a, F.element_at("echo", h + PERIOD) + back(a, PERIOD))))
    df = df.withColumn("spread", F.aggregate(steps, zeros(1), lambda a, h: push(
        a, back(a, 1) + F.element_at("psi", h + PERIOD) * F.element_at("psi", h + PERIOD))))
    return df.select("series", *COEFFICIENTS, "rss", "rows", "sigma", "path", "spread")


def forecast_series(series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(forecasts, fits) of (series, full_date, dau). The last 30 days of a
    series are forecast from the days before, with a 95% interval; a series too
    short to fit keeps its rows, with NULL forecasts. Fits have one row a
    series: coefficients, residual sd, AIC, BIC and errors over the 30 days
    (MAPE skips days without users)."""
    days = _positions(series)
    paths = _paths(fit_series(days))
    h = F.col("pos") - F.col("n_train")
    test = days.filter(h > 0).join(paths, "series", "left")
    mean = F.element_at("path", (h + PERIOD).cast("int"))
    half = Z95 * F.col("sigma") * F.sqrt(F.element_at("spread", (h + 1).cast("int")))
    test = test.withColumns({"mean": mean, "half": half})
    digits = lambda c, n=4: F.round(c, n) + F.lit(0.0)  # noqa: E731  (no negative zero)
    forecasts = test.select("series", "full_date", F.col("dau").alias("actual"), digits(F.col("mean")).alias("forecast"),
                            digits(F.col("mean") - F.col("half")).alias("lower"),
                            digits(F.col("mean") + F.col("half")).alias("upper"))
    miss = F.abs(F.col("dau") - F.col("mean"))
    once = lambda c: F.first(c).alias(c)  # noqa: E731  (one value a series)
    g = test.groupBy("series").agg(*map(once, ["n_train", *COEFFICIENTS, "rss", "rows", "sigma"]),
                                   F.avg(miss).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"),
                                   (F.avg(F.when(F.col("dau") != 0, miss / F.col("dau"))) * 100).alias("mape"))
    k, n = len(COEFFICIENTS), F.col("rows")
    fit = F.when(F.col("rss") > 0, n * F.log(F.col("rss") / n))
    fits = g.select("series", "n_train", *[digits(F.col(c), 6).alias(c) for c in COEFFICIENTS],
                    digits(F.col("sigma")).alias("sigma"), digits(fit + 2 * k).alias("aic"),
                    digits(fit + k * F.log(n)).alias("bic"), *[digits(F.col(c)).alias(c) for c in ("mae", "rmse", "mape")])
    return forecasts, fits


def _stored_series(wh: Warehouse) -> DataFrame:
    """The series, a row a day, kept once: the regressions read them several times."""
    return store(segment_series(wh), "series")


def dau_forecast(wh: Warehouse) -> DataFrame:
    """30-day forecast with a 95% interval for every series."""
    return forecast_series(_stored_series(wh))[0]


def forecast_fit(wh: Warehouse) -> DataFrame:
    """Per series: coefficients, residual sd, AIC, BIC and holdout errors."""
    return forecast_series(_stored_series(wh))[1]
