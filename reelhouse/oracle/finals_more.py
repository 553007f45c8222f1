"""Oracle SQL for window operators, data quality and EDA outputs."""
from __future__ import annotations

from ..plans.eda import CORR_FEATURES, RISKS
from ..plans.quality import DOMAINS, FOREIGN_KEYS, UNIQUE_KEYS
from ..sources.schemas import MAX_LENGTHS, RAW_SCHEMAS
from .helpers import in_list, same_text
from .sql import final, step

_WU = "(PARTITION BY user_id ORDER BY event_timestamp, event_id)"

step("gaps", ("fact_viewing_events",), f"""
SELECT event_id, user_id, event_timestamp, watch_duration_minutes,
       lag(event_timestamp) OVER {_WU} AS prev_event_timestamp,
       date_diff('second', lag(event_timestamp) OVER {_WU}, event_timestamp) AS gap_sec
FROM fact_viewing_events""")

step("sessions", ("gaps",), f"""
SELECT *, CAST(sum(CAST(is_new_session AS INTEGER)) OVER ({_WU[1:-1]} ROWS UNBOUNDED PRECEDING) AS INTEGER)
           AS session_no
FROM (SELECT *, gap_sec IS NULL OR gap_sec > 1800 AS is_new_session FROM gaps) g""")

final("event_gap_lag", ("gaps",),
      "SELECT event_id, user_id, event_timestamp, prev_event_timestamp, gap_sec FROM gaps")

final("sessions", ("sessions",), """
SELECT event_id, user_id, event_timestamp, gap_sec, is_new_session, CAST(session_no AS BIGINT) AS session_no,
       user_id || '#' || CAST(session_no AS VARCHAR) AS session_id FROM sessions""")

final("session_summary", ("sessions",), """
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, count(*) AS events,
       min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
       CAST(sum(watch_duration_minutes) AS DOUBLE) AS minutes,
       date_diff('second', min(event_timestamp), max(event_timestamp)) AS length_sec
FROM sessions GROUP BY user_id, session_no""")

final("events_sessions", (), """
SELECT event_id, user_id, ts, gap_sec, is_new_session,
       CAST(sum(CAST(is_new_session AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
FROM (SELECT *, gap_sec IS NULL OR gap_sec > 21600 AS is_new_session
      FROM (SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts,
                   (epoch_us(CAST(ts AS TIMESTAMP))
                    - epoch_us(lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY user_id ORDER BY ts, event_id)))
                   // 1000000 AS gap_sec
            FROM events) a) b""")

final("running_net_subs", ("mart_subscription_metrics",), """
SELECT ym, CAST(new_subscriptions AS BIGINT) AS new_subscriptions,
       CAST(ended_subscriptions AS BIGINT) AS ended_subscriptions, CAST(net_change AS BIGINT) AS net_change,
       CAST(sum(net_change) OVER (ORDER BY ym ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_net
FROM mart_subscription_metrics""")

final("surrogate_keys", ("dim_users", "dim_content", "raw_subscriptions"), """
SELECT 'dim_users' AS table_name, user_id AS natural_key, row_number() OVER (ORDER BY user_id) AS surrogate_key FROM dim_users
UNION ALL
SELECT 'dim_content', content_id, row_number() OVER (ORDER BY content_id) FROM dim_content
UNION ALL
SELECT 'fact_subscriptions', subscription_id, row_number() OVER (ORDER BY subscription_id) FROM raw_subscriptions""")

final("event_keys", ("raw_viewing_events",),
      "SELECT event_id, row_number() OVER (ORDER BY event_id) AS event_key FROM raw_viewing_events")

final("engagement_rank", ("mart_user_engagement",), """
SELECT user_id, CAST(total_watch_minutes AS DOUBLE) AS total_watch_minutes,
       rank() OVER w AS minutes_rank, dense_rank() OVER w AS minutes_dense_rank,
       percent_rank() OVER w AS minutes_percent_rank
FROM mart_user_engagement WINDOW w AS (ORDER BY total_watch_minutes DESC)""")

# ---- data quality ---------------------------------------------------------------
_RAW = ("raw_users", "raw_subscriptions", "raw_content", "raw_viewing_events")

final("dq_duplicates", _RAW, "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, '{c}' AS key_column, count(*) AS duplicate_keys,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM {t} GROUP BY {same_text(c) if c == 'email' else c} HAVING count(*) > 1) d""" for t, c in UNIQUE_KEYS))

final("dq_orphans", _RAW, "\nUNION ALL\n".join(f"""
SELECT '{ch}' AS child_table, '{cc}' AS child_column, '{p}' AS parent_table, count(*) AS orphan_rows
FROM {ch} WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{pc} = {ch}.{cc})""" for ch, cc, p, pc in FOREIGN_KEYS))

final("cascade_delete", _RAW, "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows_before,
       (SELECT count(*) FROM {t} x WHERE x.user_id NOT IN (SELECT user_id FROM raw_users WHERE country IS NULL))
           AS rows_after""" for t in ("raw_users", "raw_subscriptions", "raw_viewing_events")))

for _table, _columns in (
        ("users", "user_id, email, username, country, signup_date, CAST(birth_year AS BIGINT) AS birth_year"),
        ("subscriptions", "* REPLACE (CAST(monthly_price AS DOUBLE) AS monthly_price)"),
        ("viewing_events", "* REPLACE (CAST(watch_duration_sec AS BIGINT) AS watch_duration_sec)")):
    final(f"{_table}_after_delete", ("raw_users", f"raw_{_table}"), f"""
SELECT {_columns} FROM raw_{_table} x
WHERE NOT EXISTS (SELECT 1 FROM raw_users u WHERE u.country IS NULL AND u.user_id = x.user_id)""")

final("dq_nulls", _RAW, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count(*) FILTER (WHERE {f.name} IS NULL) AS null_rows, "
    f"{str(not f.nullable).upper()} AS required FROM {t}"
    for t, schema in RAW_SCHEMAS.items() for f in schema.fields))

_dom = [f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'domain' AS check_name, "
        f"count(*) FILTER (WHERE {c} NOT IN {in_list(v)}) AS violations FROM {t}" for t, c, v in DOMAINS]
_len = [f"SELECT '{t}', '{c}', 'length<={n}', count(*) FILTER (WHERE length({c}) > {n}) FROM {t}"
        for t, widths in MAX_LENGTHS.items() for c, n in widths.items()]
final("dq_domains", _RAW, "\nUNION ALL\n".join(_dom + _len))

final("dq_dirty_users", ("raw_users",), f"""
SELECT 'duplicate_email' AS issue, CAST(NULL AS VARCHAR) AS value,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows
FROM (SELECT count(*) AS n FROM raw_users GROUP BY {same_text("email")} HAVING count(*) > 1) d
UNION ALL
SELECT 'invalid_birth_year', CAST(birth_year AS VARCHAR), count(*)
FROM raw_users WHERE NOT coalesce(birth_year BETWEEN 1930 AND 2010, FALSE) GROUP BY birth_year""")

_LAYERS = ["raw_users", "raw_subscriptions", "raw_content", "raw_viewing_events", "dim_date", "dim_device",
           "dim_users", "dim_content", "fact_viewing_events", "fact_subscriptions", "mart_user_engagement",
           "mart_content_performance", "mart_subscription_metrics"]
final("layer_row_counts", tuple(_LAYERS), "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _LAYERS))

# ---- EDA ---------------------------------------------------------------------------
final("sql_to_frame", ("v_daily_active_users",), """
SELECT full_date, CAST(daily_active_users AS BIGINT) AS daily_active_users,
       CAST(total_watch_minutes AS DOUBLE) AS total_watch_minutes
FROM v_daily_active_users WHERE daily_active_users > 0""")

final("value_counts", ("mart_user_engagement",), """
SELECT churn_risk, count(*) AS users, count(*) / (SELECT count(*) FROM mart_user_engagement) AS share
FROM mart_user_engagement GROUP BY churn_risk""")

final("catalog_genre_share", ("dim_content",), """
SELECT genre, count(*) AS titles, count(*) / (SELECT count(*) FROM dim_content) AS share
FROM dim_content GROUP BY genre""")

step("risk_minutes", ("mart_user_engagement",), f"""
SELECT churn_risk, CAST(total_watch_minutes AS DOUBLE) AS x FROM mart_user_engagement
WHERE churn_risk IN {in_list(RISKS)}""")
step("risk_quartiles", ("risk_minutes",), """
SELECT churn_risk, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50,
       quantile_cont(x, 0.75) AS q75 FROM risk_minutes GROUP BY churn_risk""")
final("watch_quartiles_by_risk", ("risk_minutes", "risk_quartiles"), """
SELECT q.churn_risk, count(*) AS users, round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75,
       round(q75 - q25, 4) AS iqr,
       round(min(CASE WHEN x >= q25 - 1.5 * (q75 - q25) THEN x END), 4) AS whisker_low,
       round(max(CASE WHEN x <= q75 + 1.5 * (q75 - q25) THEN x END), 4) AS whisker_high,
       count(*) FILTER (WHERE x < q25 - 1.5 * (q75 - q25) OR x > q75 + 1.5 * (q75 - q25)) AS outliers
FROM risk_minutes m JOIN risk_quartiles q ON m.churn_risk = q.churn_risk GROUP BY q.churn_risk, q25, q50, q75""")

_pairs = [(a, b) for i, a in enumerate(CORR_FEATURES) for b in CORR_FEATURES[i + 1:]]
final("feature_correlation", ("mart_user_engagement",), "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr "
    f"FROM mart_user_engagement" for a, b in _pairs))

step("interactions", ("fact_viewing_events",), """
SELECT user_id, content_id, count(*) AS view_count, sum(CAST(is_completed AS INTEGER)) AS completions,
       ROUND(sum(watch_duration_minutes), 1) AS total_minutes
FROM fact_viewing_events GROUP BY user_id, content_id""")

final("interactions", ("interactions",), """
SELECT user_id, content_id, CAST(view_count AS BIGINT) AS view_count, CAST(completions AS BIGINT) AS completions,
       CAST(total_minutes AS DOUBLE) AS total_minutes FROM interactions""")

final("interactions_binary", ("interactions",),
      "SELECT user_id, content_id FROM interactions WHERE total_minutes > 0")

final("interaction_sparsity", ("interactions",), """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT content_id) AS n_items,
       count(*) FILTER (WHERE total_minutes > 0) AS nonzero,
       (count(DISTINCT user_id) * count(DISTINCT content_id) - count(*) FILTER (WHERE total_minutes > 0))
         / (count(DISTINCT user_id) * count(DISTINCT content_id)) AS sparsity
FROM interactions""")

final("interaction_pivot_topk", ("interactions", "content_stats"), f"""
SELECT i.user_id, {', '.join(f"CAST(coalesce(max(CASE WHEN t.item_rank = {r} THEN i.total_minutes END), 0) AS DOUBLE) AS item_{r}" for r in range(1, 11))}
FROM interactions i
LEFT JOIN (SELECT content_id, row_number() OVER (ORDER BY total_views DESC, content_id) AS item_rank
           FROM content_stats) t ON i.content_id = t.content_id AND t.item_rank <= 10
GROUP BY i.user_id""")

step("dau_series", ("v_daily_active_users",), """
SELECT CAST(c.d AS DATE) AS full_date, CAST(coalesce(v.daily_active_users, 0) AS BIGINT) AS dau
FROM (SELECT unnest(generate_series(min(full_date), max(full_date), INTERVAL 1 DAY)) AS d
      FROM v_daily_active_users WHERE daily_active_users > 0) c
LEFT JOIN (SELECT full_date, daily_active_users FROM v_daily_active_users WHERE daily_active_users > 0) v
  ON CAST(c.d AS DATE) = v.full_date""")

final("dau_summary", ("dau_series",), """
SELECT count(*) AS days, round(avg(dau), 6) AS mean_dau, round(stddev_samp(dau), 6) AS std_dau,
       min(full_date) AS first_day, max(full_date) AS last_day FROM dau_series""")

final("dau_rolling_strict", ("dau_series",), """
SELECT full_date, dau,
       CASE WHEN count(*) OVER w = 30 THEN round(avg(dau) OVER w, 6) END AS dau_30d_mean
FROM dau_series WINDOW w AS (ORDER BY full_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")

final("dau_holdout", ("dau_series",), """
SELECT full_date, dau, CASE WHEN full_date > (SELECT max(full_date) FROM dau_series) - 30 THEN 'test'
                            ELSE 'train' END AS part FROM dau_series""")
