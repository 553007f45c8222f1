"""Oracle SQL for churn features, split, scaling and evaluation tables."""
from __future__ import annotations

from ..plans.churn import BASELINE_MAX_EVENTS, FEATURES
from .sql import final, step

step("region_index", ("mart_user_engagement",), """
SELECT region, CAST(dense_rank() OVER (ORDER BY region) - 1 AS INTEGER) AS region_encoded
FROM (SELECT DISTINCT region FROM mart_user_engagement WHERE churn_risk <> 'new') r""")

step("churn_features", ("mart_user_engagement", "region_index"), f"""
SELECT m.user_id, {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}' for c in FEATURES)},
       CAST(m.churn_risk IN ('churned', 'high') AS INTEGER) AS is_churned
FROM mart_user_engagement m JOIN region_index r ON m.region = r.region
WHERE m.churn_risk <> 'new'""")

step("churn_split", ("churn_features",), """
SELECT user_id, is_churned,
       CASE WHEN row_number() OVER (PARTITION BY is_churned ORDER BY md5(user_id), user_id)
                 <= (count(*) OVER (PARTITION BY is_churned) * 2 + 9) // 10 THEN 'test' ELSE 'train' END AS split
FROM churn_features""")

step("split_features", ("churn_features", "churn_split"),
     "SELECT f.*, s.split FROM churn_features f JOIN churn_split s ON f.user_id = s.user_id")

final("region_index", ("region_index",), "SELECT region, CAST(region_encoded AS BIGINT) AS region_encoded FROM region_index")
final("churn_features", ("churn_features",), "SELECT * REPLACE (CAST(is_churned AS BIGINT) AS is_churned) FROM churn_features")
final("stratified_split", ("churn_split",), "SELECT user_id, CAST(is_churned AS BIGINT) AS is_churned, split FROM churn_split")

step("fit", ("split_features",), "SELECT " + ", ".join(
    [f"avg({c}) AS m_{c}" for c in FEATURES] + [f"stddev_pop({c}) AS s_{c}" for c in FEATURES])
     + " FROM split_features WHERE split = 'train'")
final("standardize", ("split_features", "fit"), "\nUNION ALL\n".join(
    f"SELECT user_id, split, '{c}' AS feature, round(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END, 6) AS z "
    f"FROM split_features, fit" for c in FEATURES))

final("class_weights", ("churn_split",), """
SELECT CAST(is_churned AS BIGINT) AS is_churned, count(*) AS n_class,
       (SELECT count(*) FROM churn_split WHERE split = 'train')
       / ((SELECT count(DISTINCT is_churned) FROM churn_split WHERE split = 'train') * count(*)) AS weight
FROM churn_split WHERE split = 'train' GROUP BY is_churned""")

step("baseline_scores", ("split_features",), f"""
SELECT user_id, is_churned AS actual, -total_watch_events AS score,
       CAST(total_watch_events <= {BASELINE_MAX_EVENTS} AS INTEGER) AS predicted
FROM split_features WHERE split = 'test'""")

final("confusion_matrix", ("baseline_scores",), """
SELECT CAST(c.actual AS BIGINT) AS actual, CAST(c.predicted AS BIGINT) AS predicted, coalesce(n.n, 0) AS n
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)
      WHERE EXISTS (SELECT 1 FROM baseline_scores)) c
LEFT JOIN (SELECT actual, predicted, count(*) AS n FROM baseline_scores GROUP BY 1, 2) n
  ON c.actual = n.actual AND c.predicted = n.predicted""")

step("cm", ("baseline_scores",), "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE actual = {a} AND predicted = {p}) AS c{a}{p}" for a in (0, 1) for p in (0, 1))
     + " FROM baseline_scores")
_per = []
for cls in (0, 1):
    o = 1 - cls
    tp, fp, fn = f"c{cls}{cls}", f"c{o}{cls}", f"c{cls}{o}"
    _per.append(f"""SELECT '{cls}' AS label,
       CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0 END AS precision,
       CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0.0 END AS recall,
       {tp} + {fn} AS support FROM cm""")
step("per_class", ("cm",), "SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN "
     "2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM (" + " UNION ALL ".join(_per) + ") x")
final("classification_report", ("per_class", "cm"), """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support
FROM (SELECT * FROM per_class
      UNION ALL SELECT 'accuracy', NULL, NULL, (c00 + c11) / (c00 + c01 + c10 + c11), c00 + c01 + c10 + c11 FROM cm
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per_class
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM per_class) t""")

final("roc_points", ("baseline_scores",), """
SELECT threshold, tp, fp,
       CASE WHEN p > 0 THEN tp / p END AS tpr, CASE WHEN n > 0 THEN fp / n END AS fpr
FROM (SELECT CAST(score AS DOUBLE) AS threshold,
             sum(sum(actual)) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(sum(1 - actual)) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             (SELECT count(*) FILTER (WHERE actual = 1) FROM baseline_scores) AS p,
             (SELECT count(*) FILTER (WHERE actual = 0) FROM baseline_scores) AS n
      FROM baseline_scores GROUP BY score) t""")

final("roc_auc", ("baseline_scores",), """
SELECT CAST(sum(pos) AS BIGINT) AS p, CAST(sum(one - pos) AS BIGINT) AS n,
       CASE WHEN sum(pos) > 0 AND sum(one - pos) > 0
            THEN (sum(pos * (2 * cum_one - one + 1)) - sum(pos) * (sum(pos) + 1)) / (2 * sum(pos) * sum(one - pos)) END AS auc
FROM (SELECT score, sum(actual) AS pos, count(*) AS one,
             sum(count(*)) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_one
      FROM baseline_scores GROUP BY score) t""")
