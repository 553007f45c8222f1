"""Churn modelling on the engagement mart: features, label encoding,
stratified split, train-only scaling, class weights, Spark ML models and
evaluation tables (confusion matrix, report, ROC points, AUC)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import ordered_prefix_sums
from ..operators.stored import store
from .warehouse import Warehouse

FEATURES = ["days_since_signup", "total_watch_events", "total_watch_minutes", "total_completed",
            "total_abandoned", "completion_rate", "distinct_content_watched", "distinct_days_active",
            "avg_daily_watch_min", "days_since_last_watch", "region_encoded"]
TEST_SHARE_TENTHS = 2          # 20% test, per class
BASELINE_MAX_EVENTS = 25       # baseline scorer: few events -> predicted churn
SEED = 42


def _kept(wh: Warehouse, name: str, rows) -> DataFrame:
    """``rows()`` stored once a warehouse: models pass over their input many
    times, and every pass would derive the mart from the events again."""
    if name not in wh.__dict__:
        wh.__dict__[name] = store(rows(), name)
    return wh.__dict__[name]


def modelled_users(wh: Warehouse) -> DataFrame:
    """The mart's rows of users with any activity, stored."""
    return _kept(wh, "modelled-users", lambda: wh.mart_user_engagement.filter(F.col("churn_risk") != "new").select(
        "user_id", "region", "churn_risk", "favorite_genre", "current_plan", *FEATURES[:-1]))


def region_index(wh: Warehouse) -> DataFrame:
    """Alphabetical label encoding of region (0-based) over the modelled users.
    The set of regions is tiny, so a plain window over it is fine."""
    regions = modelled_users(wh).select("region").distinct()
    return regions.withColumn("region_encoded", (F.dense_rank().over(Window.orderBy("region")) - 1).cast("int"))


def churn_features(wh: Warehouse) -> DataFrame:
    """Users with any activity; label 1 for risk churned/high; nulls -> 0."""
    m = modelled_users(wh).join(F.broadcast(region_index(wh)), "region")
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    return m.select("user_id", *cols,
                    F.col("churn_risk").isin("churned", "high").cast("int").alias("is_churned"))


def stratified_split(wh: Warehouse) -> DataFrame:
    """Per class, the first ceil(20%) users in md5(user_id) order are test.
    Users are numbered inside the 4,096 even ranges of the first three hash
    digits, after the users of the earlier ranges; the range table that gives
    that offset has at most 2 * 4,096 rows, whatever the number of users."""
    f = churn_features(wh).select("user_id", "is_churned", F.md5("user_id").alias("_h"))
    f = f.withColumn("_range", F.substring("_h", 1, 3))
    ranges = f.groupBy("is_churned", "_range").agg(F.count(F.lit(1)).alias("_size"))
    by_class = Window.partitionBy("is_churned")
    ranges = ranges.select(
        "is_churned", "_range", F.sum("_size").over(by_class).alias("_n"),
        (F.sum("_size").over(by_class.orderBy("_range")) - F.col("_size")).alias("_before"))
    w = Window.partitionBy("is_churned", "_range").orderBy("_h", "user_id")
    f = f.join(F.broadcast(ranges), ["is_churned", "_range"])
    f = f.withColumn("_pos", F.col("_before") + F.row_number().over(w))
    n_test = F.floor((F.col("_n") * TEST_SHARE_TENTHS + 9) / 10)
    return f.select("user_id", "is_churned",
                    F.when(F.col("_pos") <= n_test, "test").otherwise("train").alias("split"))


def split_features(wh: Warehouse) -> DataFrame:
    """The features with their part, stored in the order of the ids: fits and
    scores read them, and the forest draws its samples by place."""
    return _kept(wh, "split-features", lambda: churn_features(wh).join(
        stratified_split(wh).select("user_id", "split"), "user_id")
        .repartitionByRange("user_id").sortWithinPartitions("user_id"))


def standardize(wh: Warehouse) -> DataFrame:
    """(x - mean) / population sd, both fitted on the training part; a
    constant feature maps to 0. Long form: one row per user and feature;
    the fitted table has one row per feature (a bounded broadcast)."""
    d = split_features(wh)
    stack = ", ".join(f"'{c}', `{c}`" for c in FEATURES)
    long = d.select("user_id", "split", F.expr(f"stack({len(FEATURES)}, {stack}) AS (feature, x)"))
    fit = long.filter(F.col("split") == "train").groupBy("feature").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))
    j = long.join(F.broadcast(fit), "feature")
    z = F.when(F.col("sd") > 0, (F.col("x") - F.col("mean")) / F.col("sd")).otherwise(F.lit(0.0))
    return j.select("user_id", "split", "feature", F.round(z, 6).alias("z"))


def class_weights(wh: Warehouse) -> DataFrame:
    """Balanced weights n / (k * n_class) on the training part."""
    t = stratified_split(wh).filter(F.col("split") == "train")
    c = t.groupBy("is_churned").agg(F.count(F.lit(1)).alias("n_class"))
    whole = Window.partitionBy()        # over the class rows only
    return c.withColumn("weight", F.sum("n_class").over(whole)
                        / (F.count(F.lit(1)).over(whole) * F.col("n_class")))


# ---- deterministic baseline scorer (checkable by SQL) ------------------------------
def baseline_scores(wh: Warehouse) -> DataFrame:
    """Test users scored by inactivity proxy: score = -events; predicted
    churn when events <= 25."""
    d = split_features(wh).filter(F.col("split") == "test")
    return d.select("user_id", F.col("is_churned").alias("actual"),
                    (-F.col("total_watch_events")).alias("score"),
                    (F.col("total_watch_events") <= BASELINE_MAX_EVENTS).cast("int").alias("predicted"))


def confusion_matrix(wh: Warehouse, scored: DataFrame | None = None) -> DataFrame:
    s = scored if scored is not None else baseline_scores(wh)
    cells = s.select(F.explode(F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"))
                                         for a in (0, 1) for p in (0, 1)])).alias("c")) \
        .select("c.*").distinct()
    counts = s.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return cells.join(counts, ["actual", "predicted"], "left").fillna(0, ["n"])


def classification_report(wh: Warehouse, scored: DataFrame | None = None) -> DataFrame:
    """Per class precision, recall, F1 and support; accuracy; macro and
    support-weighted averages (0 where a ratio is undefined)."""
    s = scored if scored is not None else baseline_scores(wh)
    agg = s.agg(*[F.count_if((F.col("actual") == a) & (F.col("predicted") == p)).alias(f"c{a}{p}")
                  for a in (0, 1) for p in (0, 1)])
    rows = []
    for cls in (0, 1):
        other = 1 - cls
        tp, fp, fn = F.col(f"c{cls}{cls}"), F.col(f"c{other}{cls}"), F.col(f"c{cls}{other}")
        prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
        rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
        rows.append(F.struct(F.lit(str(cls)).alias("label"), prec.alias("precision"), rec.alias("recall"),
                             (tp + fn).alias("support")))
    r = agg.select(F.explode(F.array(*rows)).alias("r"), "*").select("r.*", "c00", "c01", "c10", "c11")
    r = r.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                  2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(0.0))
    per = r.select("label", "precision", "recall", "f1", "support")
    total = agg.select((F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")).alias("n"),
                       (F.col("c00") + F.col("c11")).alias("ok"))
    acc = total.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), (F.col("ok") / F.col("n")).alias("f1"),
                       F.col("n").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("label"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                       F.sum("support").alias("support"))
    out = per.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.select("label", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


def roc_points(wh: Warehouse, scored: DataFrame | None = None) -> DataFrame:
    """One point per distinct score, thresholds descending: TPR and FPR of
    'score >= threshold'. Running sums come from bucketed prefix sums."""
    s = scored if scored is not None else baseline_scores(wh)
    d = s.select(F.col("score").cast("double").alias("threshold"), F.col("actual").cast("long").alias("pos"),
                 (1 - F.col("actual")).cast("long").alias("neg"))
    ps = ordered_prefix_sums(d, "threshold", ["pos", "neg"], ascending=False)
    p, n = ps.agg(F.max("cum_pos")).scalar(), ps.agg(F.max("cum_neg")).scalar()
    return ps.select("threshold", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                     F.when(p > 0, F.col("cum_pos") / p).alias("tpr"),
                     F.when(n > 0, F.col("cum_neg") / n).alias("fpr"))


def roc_auc(wh: Warehouse, scored: DataFrame | None = None) -> DataFrame:
    """Area under ROC by the rank-sum rule with mid-ranks for ties:
    (sum over positives of 2*midrank - P(P+1)) / (2 P N), all in integers."""
    s = scored if scored is not None else baseline_scores(wh)
    d = s.select(F.col("score").cast("double").alias("score"), F.col("actual").cast("long").alias("pos"),
                 F.lit(1).cast("long").alias("one"))
    ps = ordered_prefix_sums(d, "score", ["pos", "one"], ascending=True)
    twice = ps.agg(F.sum(F.col("pos") * (2 * F.col("cum_one") - F.col("one") + 1)).alias("s2"),
                   F.sum("pos").alias("p"), F.sum(F.col("one") - F.col("pos")).alias("n"))
    return twice.select("p", "n", F.when((F.col("p") > 0) & (F.col("n") > 0),
                                         (F.col("s2") - F.col("p") * (F.col("p") + 1))
                                         / (2 * F.col("p") * F.col("n"))).alias("auc"))


# ---- Spark ML models (rows-only outputs) ---------------------------------------------
def _assembled(wh: Warehouse, scaled: bool):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    d = split_features(wh)
    va = VectorAssembler(inputCols=FEATURES, outputCol="raw_features")
    d = va.transform(d)
    train = d.filter(F.col("split") == "train")
    test = d.filter(F.col("split") == "test")
    if scaled:
        # population sd on train only: Spark's scaler uses the sample sd, so
        # rescale by sqrt((n-1)/n) to match.
        sc = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
        model = sc.fit(train)
        n = train.count()
        fix = ((n - 1) / n) ** 0.5 if n > 1 else 1.0
        from pyspark.ml.functions import array_to_vector, vector_to_array
        def rescale(df):
            t = model.transform(df)
            return t.withColumn("features", array_to_vector(
                F.transform(vector_to_array("features"), lambda x: x / F.lit(fix))))
        return rescale(train), rescale(test), n, rescale(d)
    train = train.withColumnRenamed("raw_features", "features")
    test = test.withColumnRenamed("raw_features", "features")
    return train, test, None, d.withColumnRenamed("raw_features", "features")


def churn_lr(wh: Warehouse) -> DataFrame:
    """L2 logistic regression (C = 1 as 1/n regParam) on train-scaled features."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    train, test, n, _ = _assembled(wh, scaled=True)
    lr = LogisticRegression(featuresCol="features", labelCol="is_churned", maxIter=1000,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False)
    model = lr.fit(train)
    p = model.transform(test)
    return p.select("user_id", F.col("is_churned").alias("actual"),
                    vector_to_array("probability")[1].alias("probability"),
                    F.col("prediction").cast("int").alias("predicted"))


def churn_rf(wh: Warehouse, with_importance: bool = False, everyone: bool = False):
    """Random forest: 100 trees, depth 10, balanced class weights, seed 42.
    Scores the test part, or every modelled user (``everyone``)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import vector_to_array
    train, test, _, users = _assembled(wh, scaled=False)
    w = class_weights(wh).select("is_churned", "weight")
    train = train.join(F.broadcast(w), "is_churned")
    rf = RandomForestClassifier(featuresCol="features", labelCol="is_churned", weightCol="weight",
                                numTrees=100, maxDepth=10, minInstancesPerNode=2, seed=SEED)
    model = rf.fit(train)
    p = model.transform(users if everyone else test).select(
        "user_id", F.col("is_churned").alias("actual"),
        vector_to_array("probability")[1].alias("probability"),
        F.col("prediction").cast("int").alias("predicted"))
    if with_importance:
        imp = model.featureImportances.toArray().tolist()
        rows = sorted(zip(FEATURES, imp), key=lambda t: -t[1])
        return p, wh.spark.createDataFrame(rows, "feature string, importance double")
    return p


def churn_rf_importance(wh: Warehouse) -> DataFrame:
    return churn_rf(wh, with_importance=True)[1]


def churn_targets(wh: Warehouse, threshold: float = 0.6) -> DataFrame:
    """All users, of the training part too, that the forest scores above
    ``threshold``, with their favourite genre."""
    p = churn_rf(wh, everyone=True)
    fav = modelled_users(wh).select("user_id", "favorite_genre", "region", "current_plan")
    return p.filter(F.col("probability") > threshold).join(fav, "user_id", "left")


def model_report(wh: Warehouse) -> DataFrame:
    """AUC and accuracy of both models on the test part."""
    out = []
    for name, scored in (("logistic_regression", churn_lr(wh)), ("random_forest", churn_rf(wh))):
        s = scored.select("user_id", "actual", F.col("probability").alias("score"), "predicted")
        auc = roc_auc(wh, s).select("auc")
        acc = s.agg((F.count_if(F.col("actual") == F.col("predicted")) / F.count(F.lit(1))).alias("accuracy"))
        out.append(acc.select(F.lit(name).alias("model"), "accuracy", auc.scalar().alias("auc")))
    return out[0].unionByName(out[1])
