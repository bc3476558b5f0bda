"""DuckDB SQL for each registered query (same whole tables, same column
names).  Used by the driver's correctness gate and by ``tests/``."""

from __future__ import annotations

R = 6

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


_EV_DAILY = "(SELECT CAST(ts AS DATE) AS date, user_id, event_type, value FROM events)"

sql("panel_spine", f"""
SELECT d.date, u.user_id
FROM (SELECT DISTINCT date FROM {_EV_DAILY} e WHERE date IS NOT NULL) d
CROSS JOIN (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL) u
""")

sql("rolling_active", f"""
WITH d AS (SELECT date, count(DISTINCT user_id) AS active_users FROM {_EV_DAILY} e GROUP BY date)
SELECT date, active_users,
  round(avg(active_users) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), {R}) AS active_roll2w,
  round(avg(active_users) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW), {R}) AS active_roll4w
FROM d
""")

sql("rolling_recent_log", f"""
WITH d AS (SELECT date, coalesce(sum(value), 0) AS value_sum FROM {_EV_DAILY} e GROUP BY date)
SELECT date, round(value_sum, {R}) AS value_sum,
  round(ln(1 + avg(value_sum) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)), {R}) AS recent_roll2w_log,
  round(ln(1 + avg(value_sum) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)), {R}) AS recent_roll4w_log
FROM d
""")

_SPINE_OVERLAP = f"""
spine AS (
  SELECT d.date, u.user_id
  FROM (SELECT DISTINCT date FROM {_EV_DAILY} e) d
  CROSS JOIN (SELECT DISTINCT user_id FROM events) u),
hits AS (SELECT DISTINCT date, user_id FROM {_EV_DAILY} e WHERE event_type = 'error'),
panel AS (
  SELECT s.date, s.user_id, CASE WHEN h.user_id IS NULL THEN 0 ELSE 1 END AS overlap
  FROM spine s LEFT JOIN hits h ON s.date = h.date AND s.user_id = h.user_id)
"""

sql("forward_label", f"""
WITH {_SPINE_OVERLAP}
SELECT p.date, p.user_id, p.overlap,
  CAST(coalesce((SELECT max(q.overlap) FROM panel q
                 WHERE q.user_id = p.user_id AND q.date > p.date
                   AND q.date <= p.date + INTERVAL 14 DAY), 0) AS INTEGER) AS label
FROM panel p
""")

sql("risk_panel", f"""
WITH {_SPINE_OVERLAP},
act AS (SELECT date, count(DISTINCT user_id) AS active_zones FROM {_EV_DAILY} e GROUP BY date),
act2 AS (SELECT date, active_zones,
  avg(active_zones) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS active_roll2w,
  avg(active_zones) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS active_roll4w FROM act),
val AS (SELECT date, coalesce(sum(value), 0) AS value_sum FROM {_EV_DAILY} e GROUP BY date),
val2 AS (SELECT date, value_sum,
  ln(1 + avg(value_sum) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)) AS value_roll2w_log,
  ln(1 + avg(value_sum) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)) AS value_roll4w_log FROM val),
lab AS (
  SELECT p.date, p.user_id, p.overlap,
    CAST(coalesce((SELECT max(q.overlap) FROM panel q
                   WHERE q.user_id = p.user_id AND q.date > p.date
                     AND q.date <= p.date + INTERVAL 14 DAY), 0) AS INTEGER) AS label
  FROM panel p)
SELECT l.date, l.user_id, a.active_zones,
  round(a.active_roll2w, {R}) AS active_roll2w, round(a.active_roll4w, {R}) AS active_roll4w,
  round(v.value_sum, {R}) AS value_sum, round(v.value_roll2w_log, {R}) AS value_roll2w_log,
  round(v.value_roll4w_log, {R}) AS value_roll4w_log,
  l.overlap AS active_cluster_overlap, l.label
FROM lab l LEFT JOIN act2 a ON l.date = a.date LEFT JOIN val2 v ON l.date = v.date
""")

sql("rainfall_lags", f"""
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS qty_mean
           FROM lineitem GROUP BY 1)
SELECT date, round(qty_mean, {R}) AS qty_mean,
  round(avg(qty_mean) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), {R}) AS lag1w,
  round(avg(qty_mean) OVER (ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW), {R}) AS lag2w,
  round(avg(qty_mean) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW), {R}) AS lag4w
FROM d
""")

sql("latest_nonnull", """
WITH e AS (SELECT user_id, ts, event_type,
                  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events)
SELECT user_id, max(ts) AS ts,
  arg_max(event_type, ts) FILTER (WHERE event_type IS NOT NULL) AS event_type,
  arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS value
FROM e GROUP BY user_id
""")
