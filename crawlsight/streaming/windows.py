"""Windowed statistics of streams: progress, telemetry, triggers.

Progress and telemetry are aggregations with a watermark: in update mode a sink has the newest state
of all windows (``drained_latest``), in append mode those that the watermark has passed. Rows later than
the watermark are dropped by Spark, earlier ones counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import progress, telemetry
from ..operators.quantiles import exact_quantiles
from ..operators.triggers import KEY, seconds_before, trigger_counted, trigger_match
from ..sources.tables import optional_table
from .drain import for_each_batch

LATENESS = "10 minutes"
SKETCH, SKETCH_ERROR = 800, 0.01  # Size of a quantile sketch; what its ranks are off by at most (99 of 100 by a third of it).
SERIES = ("metric", "scraper", "run_id", "step", "phase", "kind")


def progress_stream(
    requests: DataFrame,
    results: DataFrame | None = None,
    errors: DataFrame | None = None,
    lateness: str = LATENESS,
    seconds: int = progress.SNAPSHOT_SECONDS,
) -> DataFrame:
    """Counts per run and interval of up to three streams under one watermark. ``running_totals`` turns the sink into snapshots."""
    happened = progress.activity(requests, results, errors)
    return progress.interval_counts(happened.withWatermark("ts", lateness), seconds)


def telemetry_stream(metrics: DataFrame, lateness: str = LATENESS, window: str = "1 hour") -> DataFrame:
    """Copies and last time of each value per series (metric and its attributes) and window.

    ``telemetry_windows`` turns the sink into statistics. The state holds equal values once.
    """
    return (
        metrics.where(F.col("value").isNotNull())
        .withWatermark("ts", lateness)
        .groupBy(*SERIES, F.window("ts", window).alias("w"), "value")
        .agg(F.count("*").alias("copies"), F.max("ts").alias("last_at"))
        .select(*SERIES, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "value", "copies", "last_at")
    )


def telemetry_windows(values: DataFrame, probs: Sequence[float] = telemetry.QUANTILES) -> DataFrame:
    """Count, sum, range, exact quantiles and the last value of gauges, per series and window."""
    keys = [*SERIES, "window_start", "window_end"]
    stats = exact_quantiles(values, keys, "value", probs, "copies")
    last = (
        values.where(F.col("metric").isin(*telemetry.GAUGES))
        .groupBy(*keys)
        .agg(F.max_by("value", F.struct("last_at", "value")).alias("last"))
    )
    # Attributes may be NULL.
    same = [F.col(f"s.{key}").eqNullSafe(F.col(f"l.{key}")) for key in keys]
    return stats.alias("s").join(last.alias("l"), same, "left").select("s.*", "last")


def telemetry_sketch_stream(
    metrics: DataFrame, lateness: str = LATENESS, window: str = "1 hour", accuracy: int = SKETCH
) -> DataFrame:
    """Count, sum, range, last value and a quantile sketch per series and window.

    The state of a series is one sketch of a size that ``accuracy`` fixes (about 16 KB by default) however many
    different values it sees; ``telemetry_stream`` keeps them all and is exact. Values that are no number are in the
    count and sum but not in the sketch. ``sketched_quantiles`` reads the sink.
    """
    return (
        metrics.where(F.col("value").isNotNull())
        .withWatermark("ts", lateness)
        .groupBy(*SERIES, F.window("ts", window).alias("w"))
        .agg(
            F.count("*").alias("count"),
            F.sum("value").alias("sum"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.max_by("value", F.struct("ts", "value")).alias("last"),
            F.kll_sketch_agg_double(F.col("value").cast("double"), accuracy).alias("sketch"),
        )
        .select(*SERIES, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count", "sum", "min", "max", "last", "sketch")
    )


def sketched_quantiles(windows: DataFrame, probs: Sequence[float] = telemetry.QUANTILES) -> DataFrame:
    """The sink of ``telemetry_sketch_stream`` with quantiles in place of sketches: observed values whose rank is off by at
    most ``SKETCH_ERROR`` of the count. NULL where a window has no number. Only gauges have a last value."""
    found = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, probs))))
    told = windows.withColumn("_q", found).withColumn("last", F.when(F.col("metric").isin(*telemetry.GAUGES), F.col("last")))
    return told.select("*", *[F.col("_q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)]).drop("_q", "sketch")


def trigger_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    expects: Sequence[str],
    threshold: int,
    within: int,
    lateness: int = 600,
    match: Mapping[str, str | Sequence[str]] | None = None,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """The firings of ``trigger_reactive``, while events arrive; drains what is there and returns them.

    A batch closes the time up to ``lateness`` seconds before the newest event of any kind. It stores its
    expected events, and writes the firings of the time it has closed, for which it reads the events of
    ``within`` seconds before that as well. Events of closed time come too late and are left out. What the
    newest batch has not closed yet is evaluated when the result is read. Each batch owns one
    folder per table and looks only at earlier batches, so it can be repeated.
    """
    spark = events.sparkSession
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema if f.name in keys)
    stored_schema = f"{names}, ts timestamp, batch_id long"
    fired_schema = f"{names}, fired_at timestamp, events long, batch_id long"
    clock_schema = "newest timestamp, closed timestamp, batch_id long"

    def clock(batch_id: int | None) -> tuple:
        """Newest and closed time of the batches before ``batch_id``, or of all."""
        rows = optional_table(spark, f"{root}/clock", clock_schema)
        if batch_id is not None:
            rows = rows.where(F.col("batch_id") < batch_id)
        return tuple(rows.agg(F.max("newest"), F.max("closed")).first())

    def firings(stored: DataFrame, after: dt.datetime | None) -> DataFrame:
        """Firings later than ``after``."""
        if after is not None:
            stored = stored.where(F.col("ts") >= F.lit(after) - seconds_before(within))
        found = trigger_counted(stored, threshold, within, keys)
        return found if after is None else found.where(F.col("fired_at") > F.lit(after))

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest_before, closed_before = clock(batch_id)
        newest = batch.agg(F.max("ts")).first()[0]
        newest = max((t for t in (newest, newest_before) if t is not None), default=None)
        if newest is None:
            return
        closed = newest - dt.timedelta(seconds=lateness)
        closed = closed if closed_before is None else max(closed, closed_before)
        fresh = trigger_match(batch, expects, match).select(*keys, "ts").where(F.col("ts").isNotNull())
        if closed_before is not None:
            fresh = fresh.where(F.col("ts") > F.lit(closed_before))
        fresh.write.mode("overwrite").parquet(f"{root}/events/batch_id={batch_id}")
        stored = optional_table(spark, f"{root}/events", stored_schema).where(F.col("batch_id") <= batch_id)
        due = firings(stored, closed_before).where(F.col("fired_at") <= F.lit(closed))
        due.write.mode("overwrite").parquet(f"{root}/fired/batch_id={batch_id}")
        times = spark.createDataFrame([(newest, closed)], "newest timestamp, closed timestamp")
        times.write.mode("overwrite").parquet(f"{root}/clock/batch_id={batch_id}")

    for_each_batch(events, handle, checkpoint)
    _, closed = clock(None)
    fired = optional_table(spark, f"{root}/fired", fired_schema).drop("batch_id")
    return fired.unionByName(firings(optional_table(spark, f"{root}/events", stored_schema), closed))
