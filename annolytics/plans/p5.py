"""Queries of problem 5."""

from annolytics.operators.sessions import sessions
from annolytics.sources.tables import table

_CLEAN = r"""
  SELECT DISTINCT u AS user_id, epoch_us(inserted_at) AS us, lower(trim(record_id, E' \t\n\r')) AS record_id, lower(trim(task, E' \t\n\r')) AS task
  FROM (SELECT *, nullif(lower(trim(user_id, E' \t\n\r')), '') AS u FROM response_log)
  WHERE u IS NOT NULL AND inserted_at IS NOT NULL
"""
_SESSIONS = f"""
WITH e AS ({_CLEAN}),
g AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 1800000000 THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, record_id, task)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY us, record_id, task) AS session_no FROM g),
s AS (SELECT user_id, session_no::BIGINT AS session_no, min(us) AS start_us, max(us) AS end_us, count(*)::BIGINT AS n_responses FROM n GROUP BY ALL)
"""


def p5_found(spark, sf_dir):
    return sessions(table(spark, sf_dir, "response_log")).selectExpr("user_id", "start_us", "end_us", "n_events AS n_responses")


def p5_sessions(spark, sf_dir):
    return sessions(table(spark, sf_dir, "response_log")).selectExpr("user_id", "session_no", "start_us", "end_us", "duration_s", "n_events AS n_responses")


QUERIES = {"p5_found": p5_found, "p5_sessions": p5_sessions}
ORACLE = {
    "p5_found": _SESSIONS + "SELECT user_id, start_us, end_us, n_responses FROM s",
    "p5_sessions": _SESSIONS + "SELECT user_id, session_no, start_us, end_us, (end_us - start_us) / 1000000.0::DOUBLE AS duration_s, n_responses FROM s",
}
