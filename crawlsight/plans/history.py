"""Queries over run and queue history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history
from .registry import query


@query(
    "admissible_runs",
    ("flow_runs", "queues"),
    """WITH busy AS (SELECT queue, count(*) AS busy FROM flow_runs WHERE state = 'RUNNING' GROUP BY 1),
waiting AS (SELECT queue, run_id, scheduled_at,
    row_number() OVER (PARTITION BY queue ORDER BY scheduled_at, run_id) AS rank
  FROM flow_runs WHERE state = 'SCHEDULED')
SELECT w.queue, w.run_id, w.scheduled_at, CAST(w.rank AS INTEGER) AS rank
FROM waiting w JOIN queues q ON w.queue = q.queue LEFT JOIN busy b ON b.queue = w.queue
WHERE NOT q.is_paused AND (q.concurrency_limit IS NULL OR w.rank <= q.concurrency_limit - coalesce(b.busy, 0))""",
)
def _(t):
    return history.admissible_runs(t("flow_runs"), t("queues"))


@query(
    "concurrency_audit",
    ("flow_runs", "queues"),
    """WITH changes AS (
  SELECT queue, started_at AS ts, 1 AS d FROM flow_runs WHERE started_at IS NOT NULL
  UNION ALL SELECT queue, ended_at, -1 FROM flow_runs WHERE started_at IS NOT NULL AND ended_at IS NOT NULL),
moments AS (SELECT queue, ts, sum(d) AS d FROM changes GROUP BY 1, 2),
levels AS (SELECT queue, sum(d) OVER (PARTITION BY queue ORDER BY ts) AS level FROM moments)
SELECT l.queue, q.concurrency_limit, CAST(max(level) AS BIGINT) AS peak,
  count(*) FILTER (level > q.concurrency_limit) AS moments_over
FROM levels l LEFT JOIN queues q ON l.queue = q.queue GROUP BY 1, 2""",
)
def _(t):
    return history.concurrency_audit(t("flow_runs"), t("queues"))


@query(
    "queue_wait",
    ("flow_runs",),
    """WITH w AS (SELECT queue, (epoch_us(started_at) - epoch_us(scheduled_at)) / 1000000.0 AS wait
  FROM flow_runs WHERE started_at IS NOT NULL)
SELECT queue, count(*) AS runs, round(avg(CAST(wait AS DOUBLE)), 6) AS avg_wait,
  round(quantile_cont(CAST(wait AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST(wait AS DOUBLE), 0.9), 6) AS p90,
  round(quantile_cont(CAST(wait AS DOUBLE), 0.99), 6) AS p99, CAST(max(wait) AS DOUBLE) AS longest
FROM w GROUP BY 1""",
)
def _(t):
    return history.queue_wait(t("flow_runs")).select(
        "queue",
        F.col("count").alias("runs"),
        F.round("avg", 6).alias("avg_wait"),
        *[F.round(name, 6).alias(name) for name in ("p50", "p90", "p99")],
        F.col("max").alias("longest"),
    )


@query(
    "state_counts",
    ("flow_runs",),
    """SELECT queue, count(*) FILTER (state = 'COMPLETED') AS completed, count(*) FILTER (state = 'FAILED') AS failed,
  count(*) FILTER (state = 'CANCELLED') AS cancelled, count(*) FILTER (state = 'RUNNING') AS running,
  count(*) FILTER (state = 'SCHEDULED') AS scheduled, count(*) AS total
FROM flow_runs GROUP BY 1""",
)
def _(t):
    return history.state_counts(t("flow_runs"))


@query(
    "drained_runs",
    ("flow_runs",),
    """WITH a AS (SELECT run_name, count(*) FILTER (state = 'CANCELLED') AS cancelled_attempts,
    min(attempt) FILTER (state = 'CANCELLED') AS first_cancelled,
    max(attempt) FILTER (state = 'COMPLETED') AS last_completed FROM flow_runs GROUP BY 1)
SELECT *, coalesce(last_completed > first_cancelled, false) AS resumed FROM a WHERE cancelled_attempts > 0""",
)
def _(t):
    return history.drained_runs(t("flow_runs"))
