"""Streaming queries: each drains the present files and returns what its sink holds, open windows included."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import progress, telemetry
from ..session import fresh_dir
from ..sources.derive import derive
from ..sources.tables import read_stream
from ..streaming import archive as archive_streaming
from ..streaming import timers, windows
from ..streaming.drain import drained_latest
from .archive import KEYED, OBJECTS
from .registry import ORACLES, query
from .runs import PROGRESS_TABLES, PROGRESS_WINDOWS, RATE_DIGITS
from .triggers import CHILDREN, DAY, HOUR

#: The quantiles of telemetry, by column.
RANKS = {f"p{round(p * 100)}": p for p in telemetry.QUANTILES}


def stream(t, name: str):
    return derive(t.spark, t.folder, name, read_stream)


@query("progress_stream", PROGRESS_TABLES, PROGRESS_WINDOWS)
def _(t):
    intervals = drained_latest(
        windows.progress_stream(*(stream(t, name) for name in PROGRESS_TABLES)), "progress", ["run_id", "snapshot_at"]
    )
    return progress.running_totals(intervals, digits=RATE_DIGITS)


@query(
    "telemetry_stream",
    ("metrics",),
    """WITH w AS (SELECT metric, scraper, run_id, step, phase, kind, time_bucket(INTERVAL '1 hour', ts) AS window_start, count(value) AS count,
    sum(value) AS sum, min(value) AS min, max(value) AS max, arg_max(value, struct_pack(a := ts, b := value)) AS last,
    quantile_cont(value, [0.5, 0.9, 0.99]) AS q
  FROM metrics WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7)
SELECT metric, scraper, run_id, step, phase, kind, window_start, window_start + INTERVAL 1 HOUR AS window_end, count,
  round(sum, 6) AS sum, min, max, CASE WHEN metric IN ('worker.active', 'queue.pending') THEN last END AS last,
  round(q[1], 9) AS p50, round(q[2], 9) AS p90, round(q[3], 9) AS p99 FROM w""",
)
def _(t):
    keys = [*windows.SERIES, "window_start", "window_end", "value"]
    values = drained_latest(windows.telemetry_stream(stream(t, "metrics")), "telemetry", keys)
    stats = windows.telemetry_windows(values)
    return stats.withColumns({"sum": F.round("sum", 6), **{p: F.round(p, 9) for p in ("p50", "p90", "p99")}})


@query(
    "telemetry_stream_sketch",
    ("metrics",),
    """SELECT metric, scraper, run_id, step, phase, kind, time_bucket(INTERVAL '1 hour', ts) AS window_start,
  time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS window_end, count(value) AS count, round(sum(value), 6) AS sum,
  min(value) AS min, max(value) AS max,
  CASE WHEN metric IN ('worker.active', 'queue.pending') THEN arg_max(value, struct_pack(a := ts, b := value)) END AS last, true AS near
FROM metrics WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
)
def _(t):
    """``near``: counted over all values, the ranks of the three quantiles are off by no more than is stated."""
    keys = [*windows.SERIES, "window_start", "window_end"]
    states = drained_latest(windows.telemetry_sketch_stream(stream(t, "metrics")), "telemetry-sketch", keys)
    found = windows.sketched_quantiles(states)
    values = t("metrics").where(F.col("value").isNotNull()).withColumn("window_start", F.window("ts", "1 hour")["start"])
    counts = values.groupBy(*windows.SERIES, "window_start", "value").agg(F.count("*").alias("copies"))
    series = [*windows.SERIES, "window_start"]
    same = [F.col(f"v.{key}").eqNullSafe(F.col(f"f.{key}")) for key in series]
    both = counts.alias("v").join(found.alias("f"), same)
    below = [F.sum(F.when(F.col("v.value") < F.col(f"f.{p}"), F.col("v.copies")).otherwise(0)).alias(f"{p}_below") for p in RANKS]
    up_to = [F.sum(F.when(F.col("v.value") <= F.col(f"f.{p}"), F.col("v.copies")).otherwise(0)).alias(f"{p}_up_to") for p in RANKS]
    ranked = both.groupBy(*(F.col(f"f.{c}") for c in found.columns)).agg(*below, *up_to)
    slack = F.col("count") * windows.SKETCH_ERROR
    near = F.lit(True)
    for name, p in RANKS.items():
        near = near & (F.col(f"{name}_below") <= F.col("count") * p + slack) & (F.col(f"{name}_up_to") >= F.col("count") * p - slack)
    return ranked.select(*keys, "count", F.round("sum", 6).alias("sum"), "min", "max", "last", near.alias("near"))


@query("trigger_stream", (), ORACLES["trigger_reactive"])
def _(t):
    return windows.trigger_stream(
        stream(t, "trigger_events"),
        fresh_dir(t.spark, "triggers"),
        fresh_dir(t.spark, "triggers-checkpoint"),
        ["error", "view"],
        3,
        6 * HOUR,
    )


def folders(t, name: str) -> tuple[str, str]:
    return fresh_dir(t.spark, name), fresh_dir(t.spark, f"{name}-checkpoint")


@query("trigger_stream_proactive", (), ORACLES["trigger_proactive"])
def _(t):
    events = stream(t, "trigger_events")
    return timers.proactive_stream(events, *folders(t, "proactive"), ["signup"], ["purchase"], 2, 2 * DAY)


@query("trigger_stream_compound", (), ORACLES["trigger_compound"])
def _(t):
    return timers.compound_stream(stream(t, "trigger_events"), *folders(t, "compound"), [[c] for c in CHILDREN], "all", 12 * HOUR)


@query("trigger_stream_sequence", (), ORACLES["trigger_sequence"])
def _(t):
    steps = [["view"], ["click"], ["purchase"]]
    return timers.sequence_stream(stream(t, "trigger_events"), *folders(t, "sequence"), steps, DAY)


@query(
    "archive_stream",
    ("downloads",),
    f"""WITH {KEYED}, {OBJECTS.format(name="objects", source="keyed")}
SELECT o.content_key, o.size, (SELECT count(*) FROM (SELECT DISTINCT prefix, dedup_sha,
    arg_max('s3://files/' || content_key, seq) OVER (PARTITION BY prefix, dedup_sha) AS file_url FROM keyed
    WHERE dedup_sha IS NOT NULL) p WHERE p.file_url = 's3://files/' || o.content_key) AS pointers
FROM objects o""",
)
def _(t):
    """Every stored object with the number of pointers that lead to it."""
    root = fresh_dir(t.spark, "archive")
    archive_streaming.archive_stream(
        stream(t, "downloads"), root, fresh_dir(t.spark, "archive-checkpoint")
    )
    leading = (
        archive_streaming.stored_pointers(t.spark, root)
        .groupBy(F.expr("substring(file_url, length('s3://files/') + 1)").alias("content_key"))
        .agg(F.count("*").alias("pointers"))
    )
    objects = archive_streaming.stored_objects(t.spark, root).select("content_key", "size")
    return objects.join(leading, "content_key", "left").select(
        "content_key", "size", F.coalesce("pointers", F.lit(0)).alias("pointers")
    )
