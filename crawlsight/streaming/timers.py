"""Triggers with deadlines while events arrive: proactive, compound and sequence.

Time is closed by a watermark: ``lateness`` seconds before the newest event of any key. Each batch evaluates the
batch trigger over the time it closes and the ``horizon`` before that, so a deadline fires when time has passed
it, whether or not its own key is heard of again. What is kept between batches is one table of the events
that later frames can still see; it is replaced in every batch, so neither state nor folders grow with history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.triggers import KEY, is_expected, seconds_before, trigger_compound, trigger_proactive, trigger_sequence
from ..session import delete_dir
from ..sources.tables import optional_table
from .drain import for_each_batch

CLOCK = "newest timestamp, closed timestamp, batch_id long"


def timed_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    relevant: Callable[[DataFrame], DataFrame],
    evaluate: Callable[[DataFrame, dt.datetime], DataFrame],
    horizon: int,
    lateness: int = 600,
) -> DataFrame:
    """Drain ``events`` and return all firings of ``evaluate(events, as_of)``, the time not closed yet included.

    ``evaluate`` gives rows with ``fired_at`` that depend on no event older than ``horizon`` seconds before it, and on none
    that ``relevant`` leaves out. Events of closed time come too late and are left out. A batch writes one folder per
    table and reads only those of the batch before it, which stay until the next one is done: a batch may be repeated.
    """
    spark = events.sparkSession
    stored_schema = relevant(events).schema
    fired_schema = evaluate(spark.createDataFrame([], stored_schema), dt.datetime(2000, 1, 1)).schema

    def clock(before: int | None) -> tuple:
        """Newest and closed time, and the number, of the batch before ``before``, or of the last."""
        rows = optional_table(spark, f"{root}/clock", CLOCK)
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        return tuple(rows.agg(F.max("newest"), F.max("closed"), F.max("batch_id")).first())

    def held(batch_id: int | None) -> DataFrame:
        """The events that the batch kept."""
        if batch_id is None:
            return spark.createDataFrame([], stored_schema)
        return spark.read.schema(stored_schema).parquet(f"{root}/open/batch_id={batch_id}")

    def due(known: DataFrame, after: dt.datetime | None, newest: dt.datetime) -> DataFrame:
        found = evaluate(known, newest)
        return found if after is None else found.where(F.col("fired_at") > F.lit(after))

    def handle(batch: DataFrame, batch_id: int) -> None:
        newest_before, closed_before, last = clock(batch_id)
        newest = batch.agg(F.max("ts")).first()[0]
        newest = max((t for t in (newest, newest_before) if t is not None), default=None)
        if newest is None:
            return
        closed = newest - dt.timedelta(seconds=lateness)
        closed = closed if closed_before is None else max(closed, closed_before)
        fresh, kept = relevant(batch).where(F.col("ts").isNotNull()), held(last)
        if closed_before is not None:
            fresh = fresh.where(F.col("ts") > F.lit(closed_before))
            kept = kept.where(F.col("ts") >= F.lit(closed_before) - seconds_before(horizon))
        kept.unionByName(fresh).write.mode("overwrite").parquet(f"{root}/open/batch_id={batch_id}")
        fired = due(held(batch_id), closed_before, newest).where(F.col("fired_at") <= F.lit(closed))
        fired.write.mode("overwrite").parquet(f"{root}/fired/batch_id={batch_id}")
        times = spark.createDataFrame([(newest, closed)], "newest timestamp, closed timestamp")
        times.write.mode("overwrite").parquet(f"{root}/clock/batch_id={batch_id}")
        for done in range(max(0, (last if last is not None else 0) - 1), last if last is not None else 0):
            # No batch will ask for these again: a repeated batch starts from ``last``.
            delete_dir(spark, f"{root}/open/batch_id={done}")
            delete_dir(spark, f"{root}/clock/batch_id={done}")

    for_each_batch(events, handle, checkpoint)
    newest, closed, last = clock(None)
    fired = optional_table(spark, f"{root}/fired", f"{fired_schema.toDDL()}, batch_id long").drop("batch_id")
    return fired if last is None else fired.unionByName(due(held(last), closed, newest))


def proactive_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    afters: Sequence[str],
    expects: Sequence[str],
    threshold: int,
    within: int,
    lateness: int = 600,
    keys: Sequence[str] = KEY,
    match: Mapping[str, str | Sequence[str]] | None = None,
) -> DataFrame:
    """``trigger_proactive`` on a stream: fires when time has passed the deadline of an after-event that too few events followed."""
    if not afters:
        raise ValueError("windows without an after-event know no last event; evaluate them on the table")
    return timed_stream(
        events,
        root,
        checkpoint,
        lambda rows: rows.where(is_expected([*afters, *expects] if expects else (), match)),
        lambda rows, as_of: trigger_proactive(rows, afters, expects, threshold, within, as_of, keys),
        within,
        lateness,
    )


def _children(children: Sequence[Sequence[str]]) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.where(is_expected([name for child in children for name in child] if all(children) else ()))


def compound_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    children: Sequence[Sequence[str]],
    require: str | int,
    within: int,
    lateness: int = 600,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """``trigger_compound`` on a stream."""
    found = lambda rows, as_of: trigger_compound(rows, children, require, within, keys)
    return timed_stream(events, root, checkpoint, _children(children), found, within, lateness)


def sequence_stream(
    events: DataFrame,
    root: str,
    checkpoint: str,
    children: Sequence[Sequence[str]],
    within: int,
    lateness: int = 600,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """``trigger_sequence`` on a stream."""
    found = lambda rows, as_of: trigger_sequence(rows, children, within, keys)
    return timed_stream(events, root, checkpoint, _children(children), found, within, lateness)
