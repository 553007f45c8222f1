"""Oracle SQL for the daily series outputs."""
from __future__ import annotations

from .sql import final, step

step("decomp", ("dau_series",), """
SELECT full_date, dau, (full_date - (SELECT min(full_date) FROM dau_series)) % 7 AS phase,
       CASE WHEN count(*) OVER w = 7 THEN avg(dau) OVER w END AS trend
FROM dau_series WINDOW w AS (ORDER BY full_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
step("phase_means", ("decomp",), """
SELECT phase, pm - avg(pm) OVER () AS seasonal
FROM (SELECT phase, avg(dau - trend) AS pm FROM decomp GROUP BY phase) p""")
final("seasonal_decompose", ("decomp", "phase_means"), """
SELECT d.full_date, d.dau AS observed, round(d.trend, 6) AS trend, round(p.seasonal, 6) AS seasonal,
       round(d.dau - d.trend - p.seasonal, 6) AS resid
FROM decomp d JOIN phase_means p ON d.phase = p.phase""")

step("naive", ("dau_series",), """
SELECT t.full_date, t.dau AS actual, s.dau AS forecast
FROM (SELECT *, (SELECT max(full_date) FROM dau_series) - 30 AS lt FROM dau_series) t
JOIN dau_series s ON s.full_date = t.lt + CAST(((t.full_date - t.lt) - 1) % 7 - 6 AS INTEGER)
WHERE t.full_date > t.lt""")
final("dau_forecast_naive", ("naive",), "SELECT full_date, actual, forecast FROM naive")
final("forecast_metrics", ("naive",), """
SELECT count(*) AS days, round(avg(abs(actual - forecast)), 6) AS mae,
       round(sqrt(avg((actual - forecast) * (actual - forecast))), 6) AS rmse,
       round(avg(CASE WHEN actual <> 0 THEN abs(actual - forecast) / actual END) * 100, 6) AS mape
FROM naive""")

# ---- seasonal model: lists for lags, elimination over (row, column) entries, recursion over days --------
step("fc_days", ("fact_viewing_events", "dim_users", "dim_content"), """
SELECT series, d, count(DISTINCT user_id) AS dau
FROM (SELECT 'all' AS series, user_id, event_date AS d FROM fact_viewing_events
      UNION ALL SELECT 'device:' || device_type, user_id, event_date FROM fact_viewing_events
      UNION ALL SELECT 'region:' || u.region, f.user_id, f.event_date
                FROM fact_viewing_events f JOIN dim_users u ON f.user_id = u.user_id
      UNION ALL SELECT 'genre:' || c.genre, f.user_id, f.event_date
                FROM fact_viewing_events f JOIN dim_content c ON f.content_id = c.content_id) x
GROUP BY series, d""")
step("fc_lists", ("fc_days",), """
SELECT c.series, list(CAST(c.d AS DATE) ORDER BY c.d) AS ds, list(CAST(coalesce(f.dau, 0) AS DOUBLE) ORDER BY c.d) AS ys,
       greatest(count(*) - 30, 0) AS tr
FROM (SELECT series, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS d FROM fc_days GROUP BY series) c
LEFT JOIN fc_days f ON f.series = c.series AND f.d = CAST(c.d AS DATE)
GROUP BY c.series""")
step("fc_long", ("fc_lists",), """
SELECT series, t, [ys[t-1] - ys[t-8], ys[t-2] - ys[t-9], ys[t-3] - ys[t-10], ys[t-7] - ys[t-14], ys[t-14] - ys[t-21],
                   ys[t] - ys[t-7]] AS xs
FROM (SELECT series, ys, unnest(generate_series(22, tr)) AS t FROM fc_lists WHERE tr >= 56) r""")


def _elimination(rows: str, name: str, p: int) -> str:
    """Steps that solve the equations of ``rows`` (xs: p regressors, then the
    target); returns the name of the last, entries (series, i, j, v)."""
    step(f"{name}0", (rows,), f"""
SELECT series, i, j, sum(xs[i] * xs[j]) AS v
FROM {rows}, range(1, {p + 1}) AS a(i), range(1, {p + 2}) AS b(j) GROUP BY series, i, j""")
    for k in range(1, p + 1):
        step(f"{name}{k}", (f"{name}{k - 1}", f"{name}0"), f"""
SELECT m.series, m.i, m.j, CASE WHEN m.i = {k} THEN m.v / pv ELSE m.v - side.v * top.v / pv END AS v
FROM {name}{k - 1} m
JOIN (SELECT x.series, CASE WHEN x.v > 1e-9 * o.v THEN x.v END AS pv
      FROM {name}{k - 1} x JOIN {name}0 o ON o.series = x.series AND o.i = {k} AND o.j = {k}
      WHERE x.i = {k} AND x.j = {k}) piv ON piv.series = m.series
JOIN {name}{k - 1} top ON top.series = m.series AND top.i = {k} AND top.j = m.j
JOIN {name}{k - 1} side ON side.series = m.series AND side.i = m.i AND side.j = {k}""")
    return f"{name}{p}"


_first = _elimination("fc_long", "fc_a", 5)
step("fc_errors", ("fc_long", _first), f"""
SELECT l.series, l.t, l.xs, l.xs[6] - (c.cs[1] * l.xs[1] + c.cs[2] * l.xs[2] + c.cs[3] * l.xs[3] + c.cs[4] * l.xs[4]
                                       + c.cs[5] * l.xs[5]) AS e
FROM fc_long l JOIN (SELECT series, list(v ORDER BY i) AS cs FROM {_first} WHERE j = 6 GROUP BY series) c
  ON c.series = l.series""")
step("fc_model", ("fc_errors",), """
SELECT a.series, [a.xs[1], a.xs[4], b.e, c.e, a.xs[6]] AS xs
FROM fc_errors a JOIN fc_errors b ON b.series = a.series AND b.t = a.t - 1
JOIN fc_errors c ON c.series = a.series AND c.t = a.t - 7
WHERE b.e IS NOT NULL AND c.e IS NOT NULL""")
_second = _elimination("fc_model", "fc_b", 4)
step("fc_coef", (_second, "fc_model"), f"""
SELECT s.series, s.cs, r.n, CASE WHEN r.yy - q > 1e-9 * r.yy THEN r.yy - q WHEN q IS NOT NULL THEN 0.0 END AS rss
FROM (SELECT series, list(v ORDER BY i) AS cs FROM {_second} WHERE j = 5 GROUP BY series) s
JOIN (SELECT series, count(*) AS n, sum(xs[5] * xs[5]) AS yy, sum(xs[1] * xs[5]) AS b1, sum(xs[2] * xs[5]) AS b2,
             sum(xs[3] * xs[5]) AS b3, sum(xs[4] * xs[5]) AS b4 FROM fc_model GROUP BY series) r ON r.series = s.series,
LATERAL (SELECT s.cs[1] * r.b1 + s.cs[2] * r.b2 + s.cs[3] * r.b3 + s.cs[4] * r.b4 AS q) z""")
step("fc_paths", ("fc_coef", "fc_lists", "fc_errors"), """
WITH RECURSIVE p AS (
  SELECT c.series, 0 AS h, c.cs AS k, c.rss, c.n, sqrt(c.rss / (c.n - 4)) AS sigma, l.ys[l.tr - 6 : l.tr] AS ys, e.ws,
         list_concat(e.es, list_transform(range(30), lambda z: 0.0::DOUBLE)) AS es,
         list_transform(range(7), lambda z: 0.0::DOUBLE) AS us, list_transform(range(7), lambda z: 0.0::DOUBLE) AS ps,
         0.0::DOUBLE AS spread
  FROM fc_coef c JOIN fc_lists l ON l.series = c.series
  JOIN (SELECT x.series, list(x.xs[6] ORDER BY x.t) AS ws, list(x.e ORDER BY x.t) AS es
        FROM fc_errors x JOIN fc_lists y ON y.series = x.series AND x.t > y.tr - 7 GROUP BY x.series) e ON e.series = c.series
  UNION ALL
  SELECT series, h + 1, k, rss, n, sigma, list_append(ys, w + ys[-7]), list_append(ws, w), es, list_append(us, u),
         list_append(ps, u + ps[-7]), spread + (u + ps[-7]) * (u + ps[-7])
  FROM (SELECT *, k[1] * ws[-1] + k[2] * ws[-7] + k[3] * es[h + 7] + k[4] * es[h + 1] AS w,
               k[1] * us[-1] + k[2] * us[-7] + CASE h WHEN 0 THEN 1.0 WHEN 1 THEN k[3] WHEN 7 THEN k[4] ELSE 0.0 END AS u
        FROM p WHERE h < 30) q)
SELECT series, h, k, rss, n, sigma, ys[-1] AS mean, sigma * sqrt(spread) * 1.959963984540054 AS half FROM p WHERE h > 0""")
step("fc_test", ("fc_lists", "fc_paths"), """
SELECT t.series, t.tr, t.ds[t.tr + t.h] AS full_date, t.ys[t.tr + t.h] AS actual, p.mean, p.half, p.k, p.rss, p.n, p.sigma,
       abs(t.ys[t.tr + t.h] - p.mean) AS miss
FROM (SELECT *, unnest(generate_series(1, len(ys) - tr)) AS h FROM fc_lists) t
LEFT JOIN fc_paths p ON p.series = t.series AND p.h = t.h""")
final("dau_forecast", ("fc_test",), """
SELECT series, full_date, actual, round(mean, 4) + 0.0 AS forecast, round(mean - half, 4) + 0.0 AS lower,
       round(mean + half, 4) + 0.0 AS upper FROM fc_test""")
final("forecast_fit", ("fc_test",), """
SELECT series, any_value(tr) AS n_train, round(any_value(k[1]), 6) + 0.0 AS ar1, round(any_value(k[2]), 6) + 0.0 AS ar7,
       round(any_value(k[3]), 6) + 0.0 AS ma1, round(any_value(k[4]), 6) + 0.0 AS ma7,
       round(any_value(sigma), 4) + 0.0 AS sigma,
       round(CASE WHEN any_value(rss) > 0 THEN any_value(n) * ln(any_value(rss) / any_value(n)) + 8 END, 4) AS aic,
       round(CASE WHEN any_value(rss) > 0 THEN any_value(n) * ln(any_value(rss) / any_value(n))
                                               + 4 * ln(any_value(n)) END, 4) AS bic,
       round(avg(miss), 4) AS mae, round(sqrt(avg(miss * miss)), 4) AS rmse,
       round(avg(CASE WHEN actual <> 0 THEN miss / actual END) * 100, 4) AS mape
FROM fc_test GROUP BY series""")

final("dau_series", ("dau_series",), "SELECT full_date, dau FROM dau_series")
