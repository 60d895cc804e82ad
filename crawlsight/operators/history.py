"""Audits over the history of flow runs and their queues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles
from .scans import HISTORY_SLICE, running, sliced, unsliced

RUN_STATES = ("COMPLETED", "FAILED", "CANCELLED", "RUNNING", "SCHEDULED")


def seconds_between(start: str, end: str):
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def admissible_runs(flow_runs: DataFrame, queues: DataFrame) -> DataFrame:
    """Scheduled runs that may start now: per queue the oldest, up to the free slots.

    A queue without a limit (NULL) admits all its runs. Ranks are counted along time slices,
    so a queue is never sorted in one task, whatever its limit. Runs without a time come first.
    """
    busy = (
        flow_runs.where(F.col("state") == "RUNNING").groupBy("queue").agg(F.count("*").alias("busy"))
    )
    slots = (
        queues.where(~F.col("is_paused"))
        .join(busy, "queue", "left")
        .select("queue", (F.col("concurrency_limit") - F.coalesce("busy", F.lit(0))).alias("slots"))
        .where("slots IS NULL OR slots > 0")
    )
    waiting = (
        flow_runs.where(F.col("state") == "SCHEDULED")
        .select("queue", "run_id", "scheduled_at", F.lit(1).alias("one"))
        .join(slots, "queue")
    )
    ranked = running(
        sliced(waiting, ["queue"], "scheduled_at", HISTORY_SLICE), sums={"rank": "one"}, ties=["run_id"]
    )
    ranked = unsliced(ranked).where("slots IS NULL OR rank <= slots")
    return ranked.select("queue", "run_id", "scheduled_at", F.col("rank").cast("int").alias("rank"))


def concurrency_audit(flow_runs: DataFrame, queues: DataFrame) -> DataFrame:
    """Peak of overlapping runs per queue, and the number of moments over the limit.

    Starts and ends of one moment are netted first, so a run that ends just when
    the next one starts does not overlap it.
    """
    started = flow_runs.where(F.col("started_at").isNotNull())
    both = "inline(array(struct(started_at AS ts, 1 AS d), struct(ended_at AS ts, -1 AS d)))"
    changes = started.selectExpr("queue", both).where(F.col("ts").isNotNull())
    moments = changes.groupBy("queue", "ts").agg(F.sum("d").alias("d"))
    level = unsliced(
        running(sliced(moments, ["queue"], slice_seconds=HISTORY_SLICE), sums={"level": "d"})
    )
    # One row per queue and level: the limit is looked up after the moments are counted.
    levels = level.groupBy("queue", "level").agg(F.count("*").alias("moments"))
    over = F.when(F.col("level") > F.col("concurrency_limit"), F.col("moments")).otherwise(0)
    return (
        levels.join(queues.select("queue", "concurrency_limit"), "queue", "left")
        .groupBy("queue", "concurrency_limit")
        .agg(F.max("level").alias("peak"), F.sum(over).alias("moments_over"))
    )


def queue_wait(flow_runs: DataFrame, probs: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Seconds between the scheduled and the real start, per queue."""
    waits = flow_runs.where(F.col("started_at").isNotNull()).select(
        "queue", seconds_between("scheduled_at", "started_at").alias("wait")
    )
    stats = exact_quantiles(waits, ["queue"], "wait", probs)
    return stats.withColumn("avg", F.col("sum") / F.col("count"))


def state_counts(flow_runs: DataFrame) -> DataFrame:
    """Runs per queue and state; the total also counts states not listed."""
    return flow_runs.groupBy("queue").agg(
        *[F.count_if(F.col("state") == state).alias(state.lower()) for state in RUN_STATES],
        F.count("*").alias("total"),
    )


def drained_runs(flow_runs: DataFrame) -> DataFrame:
    """Run names with a cancelled attempt, and whether a later attempt completed."""
    cancelled = F.when(F.col("state") == "CANCELLED", F.col("attempt"))
    completed = F.when(F.col("state") == "COMPLETED", F.col("attempt"))
    return (
        flow_runs.groupBy("run_name")
        .agg(
            F.count(cancelled).alias("cancelled_attempts"),
            F.min(cancelled).alias("first_cancelled"),
            F.max(completed).alias("last_completed"),
        )
        .where(F.col("cancelled_attempts") > 0)
        .withColumn(
            "resumed", F.coalesce(F.col("last_completed") > F.col("first_cancelled"), F.lit(False))
        )
    )
