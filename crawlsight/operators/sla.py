"""Service-level rules and interval schedules over run history and events.

The evaluation rules are ours; the fields of a rule are given.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.steps import counted_out
from .scans import HISTORY_SLICE, running, sliced, unsliced
from .triggers import trigger_match

# Severity levels, mildest first, and the default.
SEVERITIES = ("minor", "low", "moderate", "high", "critical")
DEFAULT_SEVERITY = "high"


@dataclass(frozen=True)
class Sla:
    """One rule. Which limits are set says which kind it is."""

    name: str
    duration: float | None = None
    stale_after: float | None = None
    within: float | None = None
    expected_event: str | None = None
    resource_match: Mapping[str, str | Sequence[str]] | None = None
    severity: str | None = None
    enabled: bool = True

    @property
    def kind(self) -> str:
        if self.duration is not None:
            return "time_to_completion"
        if self.stale_after is not None:
            return "frequency"
        return "lateness" if self.expected_event is None else "freshness"


def _seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def run_seconds(as_of: dt.datetime) -> Column:
    """Time a run took, or has taken by ``as_of``; NULL before it starts."""
    return _seconds(F.col("started_at"), F.coalesce("ended_at", F.lit(as_of)))


def start_delay(as_of: dt.datetime) -> Column:
    """Time between the scheduled start and the real one, or ``as_of``."""
    return _seconds(F.col("scheduled_at"), F.coalesce("started_at", F.lit(as_of)))


def sla_time_to_completion(flow_runs: DataFrame, duration: float, as_of: dt.datetime) -> DataFrame:
    """Runs that took, or by now have taken, longer than ``duration`` seconds."""
    return flow_runs.select(
        "queue", "run_id", F.col("started_at").alias("at"), run_seconds(as_of).alias("seconds")
    ).where(F.col("seconds") > duration)


def sla_lateness(flow_runs: DataFrame, within: float, as_of: dt.datetime) -> DataFrame:
    """Runs that started later than ``within`` seconds after their time, or not yet."""
    return flow_runs.select(
        "queue", "run_id", F.col("scheduled_at").alias("at"), start_delay(as_of).alias("seconds")
    ).where(F.col("seconds") > within)


def gaps(moments: DataFrame, keys: Sequence[str], limit: float, as_of: dt.datetime) -> DataFrame:
    """Stretches without a moment that are longer than ``limit`` seconds.

    A closing row at ``as_of`` per key makes the open stretch at the end one more gap.
    """
    seen = moments.where(F.col("ts") <= F.lit(as_of)).select(*keys, "ts").distinct()
    closing = seen.groupBy(*keys).agg(F.max("ts").alias("last")).where(F.col("last") < F.lit(as_of))
    points = seen.withColumn("is_open", F.lit(False)).unionByName(
        closing.select(*keys, F.lit(as_of).alias("ts"), F.lit(True).alias("is_open"))
    )
    stepped = unsliced(running(sliced(points, keys, slice_seconds=HISTORY_SLICE), previous={"last_at": "ts"}))
    return stepped.select(
        *keys, "last_at", "is_open", _seconds(F.col("last_at"), F.col("ts")).alias("seconds")
    ).where(F.col("seconds") > limit)


def sla_frequency(flow_runs: DataFrame, stale_after: float, as_of: dt.datetime) -> DataFrame:
    started = flow_runs.where(F.col("started_at").isNotNull()).select(
        "queue", F.col("started_at").alias("ts")
    )
    return gaps(started, ["queue"], stale_after, as_of)


def sla_freshness(
    events: DataFrame,
    expected_event: str,
    within: float,
    as_of: dt.datetime,
    resource_match: Mapping[str, str | Sequence[str]] | None = None,
) -> DataFrame:
    matching = trigger_match(events, [expected_event], resource_match)
    return gaps(matching, ["resource"], within, as_of)


def violations(
    slas: Sequence[Sla], flow_runs: DataFrame, events: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """All violations of the enabled rules as (sla, kind, severity, subject, seconds).

    Rules that look at single runs are all tested in one pass over the runs.
    """
    enabled = [sla for sla in slas if sla.enabled]
    if not enabled:
        raise ValueError("no enabled rule")

    def named(sla: Sla) -> list[Column]:
        return [
            F.lit(sla.name).alias("sla"),
            F.lit(sla.kind).alias("kind"),
            F.lit(sla.severity or DEFAULT_SEVERITY).alias("severity"),
        ]

    found = []
    per_run = [sla for sla in enabled if sla.kind in ("time_to_completion", "lateness")]
    if per_run:
        took, late = run_seconds(as_of), start_delay(as_of)
        tests = [
            F.struct(
                *named(sla),
                (took if sla.kind == "time_to_completion" else late).alias("seconds"),
                F.lit(float(sla.within if sla.duration is None else sla.duration)).alias("limit"),
            )
            for sla in per_run
        ]
        rows = flow_runs.select(F.col("queue").alias("subject"), F.inline(F.array(*tests)))
        found.append(
            rows.where(F.col("seconds") > F.col("limit")).select(
                "sla", "kind", "severity", "subject", "seconds"
            )
        )
    for sla in enabled:
        if sla.kind == "frequency":
            rows = sla_frequency(flow_runs, sla.stale_after, as_of)
            found.append(rows.select(*named(sla), F.col("queue").alias("subject"), "seconds"))
        elif sla.kind == "freshness":
            rows = sla_freshness(events, sla.expected_event, sla.within, as_of, sla.resource_match)
            subject = F.col("resource").cast("string").alias("subject")
            found.append(rows.select(*named(sla), subject, "seconds"))
    every = found[0]
    for each in found[1:]:
        every = every.unionByName(each)
    return every


def sla_severity_rollup(found: DataFrame) -> DataFrame:
    """Violations per severity and kind, with totals (``level`` tells them from keys)."""
    per_kind = found.groupBy("severity", "kind").agg(F.count("*").alias("n"))
    return per_kind.cube("severity", "kind").agg(
        F.sum("n").alias("violations"), F.grouping_id().cast("int").alias("level")
    )


def schedule_expand(schedules: DataFrame, until: dt.datetime) -> DataFrame:
    """Expected run times of interval schedules up to ``until``, at most ``max_scheduled_runs`` each.

    A queue may have several schedules, told apart by ``schedule_id``; without that column it has one. The cap is
    applied to the number of slots before any row is made.
    """
    passed = F.unix_micros(F.lit(until)) - F.unix_micros("anchor")
    step = F.col("interval_seconds") * 1_000_000
    slots = F.least(F.floor(passed / step) + 1, F.col("max_scheduled_runs"))
    return counted_out(identified(schedules), slots, "slot").select(
        "queue",
        "schedule_id",
        "slot",
        F.timestamp_micros(F.unix_micros("anchor") + F.col("slot") * step).alias("expected_at"),
    )


def identified(schedules: DataFrame) -> DataFrame:
    return schedules if "schedule_id" in schedules.columns else schedules.withColumn("schedule_id", F.col("queue"))


def missed_runs(schedules: DataFrame, flow_runs: DataFrame, until: dt.datetime) -> DataFrame:
    """Expected times without a run before the next expected time of the same schedule.

    A run's slot follows from its time and the schedule, so the match is on equal (schedule, slot) and needs no
    interval join. A run stands for a slot of every schedule of its queue, or of the one that its ``schedule_id``
    names where runs have that column.
    """
    step = F.col("interval_seconds") * 1_000_000
    slot = F.floor((F.unix_micros("scheduled_at") - F.unix_micros("anchor")) / step)
    known = identified(schedules).select("queue", "schedule_id", "anchor", "interval_seconds")
    told = "schedule_id" in flow_runs.columns
    runs = flow_runs.select("queue", "scheduled_at", *([F.col("schedule_id").alias("own")] if told else []))
    taken = runs.join(known, "queue")
    if told:
        taken = taken.where(F.col("own").isNull() | (F.col("own") == F.col("schedule_id")))
    taken = taken.select("queue", "schedule_id", slot.alias("slot")).distinct()
    return schedule_expand(schedules, until).join(taken, ["queue", "schedule_id", "slot"], "left_anti")
