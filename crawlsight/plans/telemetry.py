"""Queries over metrics and spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import telemetry
from .registry import query

HISTOGRAMS = ", ".join(f"'{name}'" for name in telemetry.HISTOGRAMS)
STATS = """count({v}) AS count, round(sum({v}), 6) AS sum, min({v}) AS min, max({v}) AS max,
  round(quantile_cont({v}, 0.5), 9) AS p50, round(quantile_cont({v}, 0.9), 9) AS p90,
  round(quantile_cont({v}, 0.99), 9) AS p99"""
VALUE_STATS = STATS.format(v="value")


def rounded(stats):
    """Sums and quantiles rounded where both engines are sure to agree."""
    digits = {"sum": 6, "p50": 9, "p90": 9, "p99": 9}
    return stats.select(
        *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in stats.columns]
    )


@query(
    "metric_histograms",
    ("metrics",),
    f"""SELECT metric, scraper, pool, {VALUE_STATS} FROM metrics WHERE metric IN ({HISTOGRAMS})
GROUP BY 1, 2, 3""",
)
def _(t):
    return rounded(telemetry.metric_histograms(t("metrics"), ["scraper", "pool"]))


@query(
    "metric_phases",
    ("metrics",),
    f"""SELECT metric, scraper, step, phase, kind, {VALUE_STATS} FROM metrics WHERE metric IN ({HISTOGRAMS})
GROUP BY ALL""",
)
def _(t):
    """Histograms by every attribute of a metric of its own."""
    return rounded(telemetry.metric_histograms(t("metrics"), ["scraper", "step", "phase", "kind"]))


@query(
    "metric_buckets_by_phase",
    ("metrics",),
    f"""SELECT m.metric, m.phase, m.kind, b.bound, count(*) FILTER (b.bound IS NULL OR m.value <= b.bound) AS n
FROM metrics m, (SELECT unnest([{', '.join(map(str, telemetry.BUCKET_BOUNDS))}, NULL]::DOUBLE[]) AS bound) b
WHERE m.metric IN ({HISTOGRAMS}) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    return telemetry.metric_buckets(t("metrics"), attributes=["phase", "kind"])


@query(
    "metric_buckets",
    ("metrics",),
    f"""SELECT m.metric, b.bound, count(*) FILTER (b.bound IS NULL OR m.value <= b.bound) AS n
FROM metrics m, (SELECT unnest([{', '.join(map(str, telemetry.BUCKET_BOUNDS))}, NULL]::DOUBLE[]) AS bound) b
WHERE m.metric IN ({HISTOGRAMS}) GROUP BY 1, 2""",
)
def _(t):
    return telemetry.metric_buckets(t("metrics"))


@query(
    "gauge_last",
    ("metrics",),
    """SELECT metric, scraper, run_id, arg_max(value, ts) AS value, max(ts) AS ts FROM metrics
WHERE metric IN ('worker.active', 'queue.pending') GROUP BY 1, 2, 3""",
)
def _(t):
    return telemetry.gauge_last(t("metrics"))


@query(
    "phase_breakdown",
    ("spans",),
    """WITH total AS (SELECT scraper, step, sum(seconds) FILTER (name = 'request') AS total FROM spans GROUP BY 1, 2),
names AS (SELECT unnest(['total', 'rate_limiter.gate', 'transport.resolve', 'continuation', 'archive.lookup',
  'archive.download', 'archive.upload', 'compress']) AS phase),
sums AS (SELECT scraper, step, CASE name WHEN 'request' THEN 'total' ELSE name END AS phase, sum(seconds) AS seconds
  FROM spans GROUP BY 1, 2, 3)
SELECT t.scraper, t.step, n.phase, round(coalesce(s.seconds, 0), 6) AS seconds,
  round(coalesce(s.seconds, 0) / nullif(t.total, 0), 10) AS share
FROM total t CROSS JOIN names n
LEFT JOIN sums s ON s.scraper = t.scraper AND s.step = t.step AND s.phase = n.phase""",
)
def _(t):
    return telemetry.phase_breakdown(t("spans")).select(
        "scraper", "step", "phase", F.round("seconds", 6).alias("seconds"), F.round("share", 10).alias("share")
    )


@query(
    "archive_phase_compare",
    ("spans",),
    """WITH s AS (SELECT name, backend, count(*) AS n, quantile_cont(seconds, 0.5) AS p50,
    quantile_cont(seconds, 0.9) AS p90 FROM spans
  WHERE name IN ('archive.lookup', 'archive.download', 'archive.upload') GROUP BY 1, 2),
w AS (SELECT name AS phase, max(n) FILTER (backend = 's3') AS count_s3, max(n) FILTER (backend = 'local') AS count_local,
    max(p50) FILTER (backend = 's3') AS p50_s3, max(p50) FILTER (backend = 'local') AS p50_local,
    max(p90) FILTER (backend = 's3') AS p90_s3, max(p90) FILTER (backend = 'local') AS p90_local FROM s GROUP BY 1)
SELECT phase, count_s3, count_local, round(p50_s3, 9) AS p50_s3, round(p50_local, 9) AS p50_local,
  round(p90_s3, 9) AS p90_s3, round(p90_local, 9) AS p90_local, round(p50_local / nullif(p50_s3, 0), 10) AS ratio FROM w""",
)
def _(t):
    side = telemetry.archive_phase_compare(t("spans"))
    return side.select(
        "phase",
        "count_s3",
        "count_local",
        *[F.round(c, 9).alias(c) for c in ("p50_s3", "p50_local", "p90_s3", "p90_local")],
        F.round("ratio", 10).alias("ratio"),
    )


@query(
    "setting_compare",
    ("metrics",),
    f"""SELECT max_workers, {VALUE_STATS} FROM metrics WHERE metric = 'request.duration' GROUP BY 1""",
)
def _(t):
    return rounded(telemetry.setting_compare(t("metrics"), "request.duration", "max_workers"))


@query(
    "loop_lag_by_mode",
    ("metrics",),
    f"""SELECT run_pool, {VALUE_STATS} FROM metrics WHERE metric = 'event_loop.lag' GROUP BY 1""",
)
def _(t):
    return rounded(telemetry.loop_lag_by_mode(t("metrics")))


@query(
    "run_correlation",
    ("spans", "metrics", "runs"),
    """WITH b AS (SELECT run_id, count(*) AS spans, sum(seconds) AS seconds, 0 AS points FROM spans GROUP BY 1
  UNION ALL SELECT run_id, 0, 0, count(*) FROM metrics GROUP BY 1),
g AS (SELECT run_id, sum(spans) AS spans, sum(seconds) AS seconds, sum(points) AS points FROM b GROUP BY 1)
SELECT g.run_id, CAST(spans AS BIGINT) AS spans, round(seconds, 6) AS seconds, CAST(points AS BIGINT) AS points,
  r.source_path, r.schema FROM g LEFT JOIN runs r ON g.run_id = r.run_id""",
)
def _(t):
    both = telemetry.run_correlation(t("spans"), t("metrics"), t("runs"))
    return both.withColumn("seconds", F.round("seconds", 6))


@query(
    "run_correlation_spans",
    ("spans", "runs"),
    """SELECT s.span_id, s.trace_id, s.name, s.run_id, r.source_path, r.schema
FROM spans s LEFT JOIN runs r ON s.run_id = r.run_id""",
)
def _(t):
    return telemetry.with_run(t("spans").select("span_id", "trace_id", "name", "run_id"), t("runs"))


@query(
    "span_tree",
    ("spans",),
    """WITH c AS (SELECT trace_id, parent_id, sum(seconds) AS s FROM spans WHERE parent_id IS NOT NULL GROUP BY 1, 2)
SELECT s.trace_id, s.span_id, s.name, round(s.seconds - coalesce(c.s, 0), 6) AS self_seconds,
  CASE WHEN s.parent_id IS NULL THEN 0 WHEN p.parent_id IS NULL THEN 1 ELSE 2 END AS depth
FROM spans s LEFT JOIN c ON c.trace_id = s.trace_id AND c.parent_id = s.span_id
LEFT JOIN spans p ON p.trace_id = s.trace_id AND p.span_id = s.parent_id""",
)
def _(t):
    return telemetry.span_tree(t("spans")).withColumn("self_seconds", F.round("self_seconds", 6))


@query(
    "trace_sample",
    ("spans",),
    """SELECT span_id, trace_id, name FROM spans
WHERE (trace_id % 4294967296 * 1103515245) % 4294967296 < 214748364""",
)
def _(t):
    return telemetry.trace_sample(t("spans")).select("span_id", "trace_id", "name")


@query(
    "bottleneck_diagnosis",
    ("metrics", "spans"),
    """WITH p AS (
  SELECT run_id, metric AS name, value FROM metrics
    WHERE metric <> 'request.cpu_time' OR phase IN ('compress', 'continuation')
  UNION ALL SELECT run_id, name, seconds FROM spans WHERE run_id IS NOT NULL),
q AS (SELECT run_id, coalesce(quantile_cont(value, 0.99) FILTER (name = 'event_loop.lag'), 0) AS lag,
    coalesce(quantile_cont(value, 0.99) FILTER (name = 'request.cpu_time'), 0) AS cpu,
    coalesce(quantile_cont(value, 0.99) FILTER (name = 'db.lock.wait'), 0) AS lock,
    coalesce(quantile_cont(value, 0.99) FILTER (name = 'rate_limiter.gate'), 0) AS gate,
    coalesce(quantile_cont(value, 0.99) FILTER (name = 'transport.resolve'), 0) AS client,
    count(*) FILTER (name IN ('event_loop.lag', 'request.cpu_time', 'db.lock.wait', 'rate_limiter.gate',
      'transport.resolve')) AS n
  FROM p GROUP BY 1)
SELECT run_id, round(lag, 9) AS lag, round(cpu, 9) AS cpu, round(lock, 9) AS lock, round(gate, 9) AS gate,
  round(client, 9) AS client,
  CASE WHEN lag > 0.15 AND cpu > 0.15 AND client <= 0.2 THEN 'cpu_saturated'
    WHEN lag <= 0.15 AND lock > 0.15 THEN 'db_lock_bound'
    WHEN lag <= 0.15 AND lock <= 0.15 AND gate > 0.2 THEN 'rate_limited'
    WHEN lag <= 0.15 AND lock <= 0.15 AND gate <= 0.2 AND cpu <= 0.15 THEN 'io_bound'
    ELSE 'unclear' END AS diagnosis
FROM q WHERE n > 0""",
)
def _(t):
    wide = telemetry.bottleneck_diagnosis(t("metrics"), t("spans"))
    return wide.select(
        "run_id",
        *[F.round(c, 9).alias(c) for c in ("lag", "cpu", "lock", "gate", "client")],
        "diagnosis",
    )
