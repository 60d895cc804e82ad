"""Progress statistics of running crawls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.steps import counted_out
from ..sources.schemas import REQUEST_STATUSES

SNAPSHOT_SECONDS = 300  # Fixed value: time between two snapshots.
COUNTS = ("total", *REQUEST_STATUSES, "results", "valid", "invalid", "errors")


def run_status() -> Column:
    """Where a run stands, by its counts: the origin asks the running process. The rule is ours.

    ``waiting``: no request has been taken up; ``running``: some are open; ``settled``: none is.
    """
    opened = F.col("pending") + F.col("in_progress") > 0
    return F.when(F.col("total") == F.col("pending"), "waiting").when(opened, "running").otherwise("settled")


def status_counts() -> list:
    """One conditional count per known state; the total counts unknown states too."""
    return [F.count("*").alias("total")] + [
        F.count_if(F.coalesce(F.col("status") == name, F.lit(False))).alias(name)
        for name in REQUEST_STATUSES
    ]


def throughput_per_minute(requests: DataFrame) -> DataFrame:
    """Completed requests per minute between the first and the last of them.

    NULL where that span is zero. The clock rule is ours.
    """
    done = requests.where(F.col("status") == "completed")
    seconds = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1_000_000
    return done.groupBy("run_id").agg(
        F.count("*").alias("completed"),
        F.try_divide(F.count("*"), seconds / 60).alias("requests_per_minute"),
    )


def progress_snapshot(
    runs: DataFrame, requests: DataFrame, results: DataFrame, errors: DataFrame
) -> DataFrame:
    """Status, queue, result and error counts and the throughput of every run."""
    done = F.col("status") == "completed"
    first = F.min(F.when(done, F.unix_micros("ts")))
    last = F.max(F.when(done, F.unix_micros("ts")))
    minutes = (last - first) / 60_000_000
    queue = requests.groupBy("run_id").agg(
        *status_counts(), F.try_divide(F.count_if(done), minutes).alias("requests_per_minute")
    )
    valid = F.coalesce(F.col("is_valid") != 0, F.lit(False))
    harvested = results.groupBy("run_id").agg(
        F.count("*").alias("results"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
    )
    failed = errors.groupBy("run_id").agg(F.count("*").alias("errors"))
    return (
        runs.select("run_id")
        .join(queue, "run_id", "left")
        .join(harvested, "run_id", "left")
        .join(failed, "run_id", "left")
        .select(
            "run_id",
            *[F.coalesce(name, F.lit(0)).alias(name) for name in COUNTS],
            "requests_per_minute",
        )
        .withColumn("status", run_status())
    )


def activity(requests: DataFrame, results: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """What happened when, as one table or one stream: run_id, ts, kind, state.

    One union means one watermark: a stream's interval is closed when all three sources have passed it.
    """
    rows = requests.select("run_id", "ts", F.lit("request").alias("kind"), F.col("status").alias("state"))
    if results is not None:
        state = F.when(F.coalesce(F.col("is_valid") != 0, F.lit(False)), "valid").otherwise("invalid")
        rows = rows.unionByName(results.select("run_id", "ts", F.lit("result").alias("kind"), state.alias("state")))
    if errors is not None:
        nothing = F.lit(None).cast("string").alias("state")
        rows = rows.unionByName(errors.select("run_id", "ts", F.lit("error").alias("kind"), nothing))
    return rows


def interval_counts(happened: DataFrame, seconds: int = SNAPSHOT_SECONDS) -> DataFrame:
    """Counts per run and interval of :func:`activity`, and its first and last completed request; of batches and of streams."""

    def of(kind: str, state: str | None = None):
        test = F.col("kind") == kind
        return F.count_if(F.coalesce(test if state is None else test & (F.col("state") == state), F.lit(False)))

    completed = F.when((F.col("kind") == "request") & (F.col("state") == "completed"), F.col("ts"))
    return (
        happened.groupBy("run_id", F.window("ts", f"{seconds} seconds").alias("w"))
        .agg(
            of("request").alias("total"),
            *[of("request", name).alias(name) for name in REQUEST_STATUSES],
            of("result").alias("results"),
            of("result", "valid").alias("valid"),
            of("result", "invalid").alias("invalid"),
            of("error").alias("errors"),
            F.min(completed).alias("first_done"),
            F.max(completed).alias("last_done"),
        )
        .select("run_id", F.col("w.end").alias("snapshot_at"), *COUNTS, "first_done", "last_done")
    )


def running_totals(intervals: DataFrame, seconds: int = SNAPSHOT_SECONDS, digits: int | None = None) -> DataFrame:
    """State of each run at the end of every interval from its first to its last activity, quiet ones included.

    The window holds one row per interval of a run in which something happened, however much. A quiet interval
    repeats the snapshot before it: those rows are made after the sums, and never shuffled. ``digits`` rounds the
    rates, once for all the intervals that repeat them.
    """
    along = Window.partitionBy("run_id").orderBy("snapshot_at")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.lit(seconds * 1_000_000)
    until_next = (F.unix_micros(F.lead("snapshot_at").over(along)) - F.unix_micros("snapshot_at")) / step
    minutes = (F.unix_micros(F.max("last_done").over(so_far)) - F.unix_micros(F.min("first_done").over(so_far))) / 60_000_000
    summed = intervals.select(
        "run_id",
        "snapshot_at",
        F.col("completed").alias("done_here"),
        *[F.sum(name).over(so_far).alias(name) for name in COUNTS],
        minutes.alias("minutes"),
        F.coalesce(until_next.cast("long"), F.lit(1)).alias("until_next"),
    )
    rate = F.try_divide(F.col("completed"), F.col("minutes"))
    told = summed.select(
        "run_id", "done_here", *COUNTS, "until_next",
        (rate if digits is None else F.round(rate, digits)).alias("requests_per_minute"),
        run_status().alias("status"),
        F.unix_micros("snapshot_at").alias("at"),
    )
    # The rows are few here and many below: a run with long gaps is dealt out to all tasks first.
    told = told.repartition(int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run_id", "at")
    every = counted_out(told, F.col("until_next"), "quiet")
    return every.select(
        "run_id",
        F.timestamp_micros(F.col("at") + F.col("quiet") * step).alias("snapshot_at"),
        F.when(F.col("quiet") == 0, F.col("done_here")).otherwise(0).alias("completed_in_interval"),
        *COUNTS,
        "requests_per_minute",
        "status",
    )


def progress_windows(
    requests: DataFrame,
    results: DataFrame | None = None,
    errors: DataFrame | None = None,
    seconds: int = SNAPSHOT_SECONDS,
    digits: int | None = None,
) -> DataFrame:
    """Whole snapshots at the end of every interval: status, counts of requests, results and errors, rate so far."""
    return running_totals(interval_counts(activity(requests, results, errors), seconds), seconds, digits)
