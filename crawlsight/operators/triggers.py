"""Event triggers over a table of events.

The rules are ours; only the fields of a trigger are given. All frames are closed:
"within s" at time t means [t - s, t]. A trigger fires at the moment that lifts
its condition from false to true, so it does not fire again while it holds.

Events of one key and moment are added up first, and time is scanned in slices
(see ``scans``), so neither a busy key nor a burst is collected anywhere.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.steps import counted_out
from .scans import frame_sums, running, since, sliced, unsliced

KEY = ("resource",)
COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}


def seconds_before(seconds: float) -> Column:
    return F.expr(f"INTERVAL '{seconds}' SECOND")


def label_fits(value: Column, allowed: str | Sequence[str]) -> Column:
    """Whether a label has one of the allowed values and none of the forbidden ones.

    A value that ends with ``*`` stands for all that begin so, one that begins with ``!`` is forbidden. A label that is
    missing fits nothing. Where only forbidden values are named, all others are allowed.
    """
    names = [allowed] if isinstance(allowed, str) else list(allowed)
    wanted, unwanted = [n for n in names if not n.startswith("!")], [n[1:] for n in names if n.startswith("!")]

    def any_of(values: Sequence[str]) -> Column:
        exact = [n for n in values if not n.endswith("*")]
        tests = [F.startswith(value, F.lit(n[:-1])) for n in values if n.endswith("*")] + ([value.isin(*exact)] if exact else [])
        return reduce(operator.or_, tests, F.lit(False))

    fits = any_of(wanted) if wanted else F.lit(True)
    return F.coalesce(value.isNotNull() & fits & ~any_of(unwanted), F.lit(False))


def label(name: str) -> Column:
    """A label of the JSON map ``props``; NULL where it is missing."""
    return F.try_element_at(F.from_json("props", "map<string,string>"), F.lit(name))


def is_expected(expects: Sequence[str], match: Mapping[str, str | Sequence[str]] | None = None) -> Column:
    """Event names (none: any event) and labels (see :func:`label_fits`)."""
    test = F.col("event").isin(*expects) if expects else F.lit(True)
    for name, allowed in (match or {}).items():
        test = test & label_fits(label(name), allowed)
    return test


def for_each(events: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Events with a column for each label, by column name, to be used as ``keys``: a trigger is then
    evaluated separately for each combination of their values. Events that lack one of the labels are left out."""
    found = events.withColumns({column: label(name) for column, name in labels.items()})
    return found.where(reduce(operator.and_, (F.col(column).isNotNull() for column in labels), F.lit(True)))


def trigger_match(
    events: DataFrame, expects: Sequence[str], match: Mapping[str, str | Sequence[str]] | None = None
) -> DataFrame:
    return events.where(is_expected(expects, match))


def _moments(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.groupBy(*keys, "ts").agg(F.count("*").alias("n"))


def trigger_reactive(
    events: DataFrame,
    expects: Sequence[str],
    threshold: int,
    within: int,
    match: Mapping[str, str | Sequence[str]] | None = None,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """Fires when the events of a moment lift the count within the frame to the threshold."""
    return trigger_counted(trigger_match(events, expects, match), threshold, within, keys)


def trigger_counted(expected: DataFrame, threshold: int, within: int, keys: Sequence[str] = KEY) -> DataFrame:
    """As ``trigger_reactive``, of the expected events alone (keys, ts)."""
    counted = since(_moments(expected, keys), keys, ["n"], within)
    reached = F.col("n_since") >= threshold
    before = F.col("n_since") - F.col("n") >= threshold
    return counted.where(reached & ~before).select(
        *keys, F.col("ts").alias("fired_at"), F.col("n_since").alias("events")
    )


def trigger_proactive(
    events: DataFrame,
    afters: Sequence[str],
    expects: Sequence[str],
    threshold: int,
    within: int,
    as_of: dt.datetime,
    keys: Sequence[str] = KEY,
    match: Mapping[str, str | Sequence[str]] | None = None,
) -> DataFrame:
    """Fires at the deadline of an after-event that fewer expected events follow than asked for.

    ``match`` holds for after-events and expected ones alike. The count of (t, t + within] is the difference of two running counts, taken by
    probe rows at both ends; events are never paired with each other.
    """
    if match:
        events = events.where(is_expected((), match))
    if not afters:
        return _idle_windows(events, expects, threshold, within, as_of, keys)
    # One pass: what a moment counts, and the two probes of a moment that starts a wait.
    moments = (
        events.where(is_expected(expects) | F.col("event").isin(*afters))
        .groupBy(*keys, "ts")
        .agg(
            F.count_if(is_expected(expects)).alias("n"),
            F.max(F.col("event").isin(*afters)).alias("starts"),
        )
    )
    mark = "struct(ts AS at, n AS n, 0 AS _side, 0 AS _sign)"
    probe = "struct(ts{} AS at, 0L AS n, {} AS _side, {} AS _sign)"
    wait = f"{probe.format('', 1, -1)}, {probe.format(f' + INTERVAL {within} SECOND', 2, 1)}"
    points = moments.selectExpr(
        *keys, "ts AS after_at", f"inline(IF(starts, array({mark}, {wait}), array({mark})))"
    )
    points = sliced(points, keys, "at")
    scanned = running(points, sums={"_count": "n"}, ties=["_side"]).where(F.col("_side") > 0)
    return (
        scanned.groupBy(*keys, "after_at")
        .agg(F.sum(F.col("_count") * F.col("_sign")).alias("events"))
        .withColumn("fired_at", F.col("after_at") + seconds_before(within))
        .where((F.col("events") < threshold) & (F.col("fired_at") <= F.lit(as_of)))
    )


def _idle_windows(
    events: DataFrame,
    expects: Sequence[str],
    threshold: int,
    within: int,
    as_of: dt.datetime,
    keys: Sequence[str],
) -> DataFrame:
    """Without after-events: tumbling windows of each key, empty ones included."""
    width = within * 1_000_000
    slot = F.floor(F.unix_micros("ts") / F.lit(width))
    wanted = F.count_if(is_expected(expects))
    counts = events.groupBy(*keys, slot.alias("slot")).agg(wanted.alias("n"))
    last = F.floor(F.unix_micros(F.lit(as_of)) / F.lit(width)) - 1
    known = counts.groupBy(*keys).agg(F.min("slot").alias("first")).where(F.col("first") <= last)
    slots = counted_out(known, last - F.col("first") + 1, "_later").select(*keys, (F.col("first") + F.col("_later")).alias("slot"))
    end = F.timestamp_micros((F.col("slot") + 1) * F.lit(width))
    seen = F.coalesce("n", F.lit(0))
    return (
        slots.join(counts, [*keys, "slot"], "left")
        .where(seen < threshold)
        .select(*keys, end.alias("fired_at"), seen.alias("events"))
    )


def as_events(firings: Mapping[str, DataFrame], keys: Sequence[str] = KEY) -> DataFrame:
    """Firings of any triggers as events with the children's names.

    ``trigger_compound`` and ``trigger_sequence`` over them are triggers over triggers: their children may
    have thresholds, frames, matches, or be compound themselves.
    """
    named = [
        fired.select(*keys, F.col("fired_at").cast("timestamp").alias("ts"), F.lit(name).alias("event"), F.lit(None).cast("string").alias("props"))
        for name, fired in firings.items()
    ]
    return reduce(DataFrame.unionByName, named)


def trigger_compound(
    events: DataFrame,
    children: Sequence[Sequence[str]],
    require: str | int,
    within: int,
    keys: Sequence[str] = KEY,
) -> DataFrame:
    """Fires when enough different children have fired within the frame.

    ``require`` is 'any', 'all' or a number. Only each child's latest firing matters,
    so a running maximum per child replaces a set of firings.
    """
    need = {"any": 1, "all": len(children)}.get(require, require)
    flags = [
        F.max(F.when(is_expected(child), F.col("ts"))).alias(f"c{i}") for i, child in enumerate(children)
    ]
    any_child = F.lit(False)
    for child in children:
        any_child = any_child | is_expected(child)
    moments = events.where(any_child).groupBy(*keys, "ts").agg(*flags)
    scanned = running(sliced(moments, keys), maxes={f"m{i}": f"c{i}" for i in range(len(children))})
    edge = F.col("ts") - seconds_before(within)
    before, now = F.lit(0), F.lit(0)
    for i in range(len(children)):
        held = F.coalesce(F.col(f"m{i}") >= edge, F.lit(False))
        before = before + held.cast("int")
        now = now + (held | F.col(f"c{i}").isNotNull()).cast("int")
    return (
        unsliced(scanned)
        .select(*keys, F.col("ts").alias("fired_at"), before.alias("before"), now.alias("active"))
        .where((F.col("before") < need) & (F.col("active") >= need))
        .drop("before")
    )


def trigger_sequence(
    events: DataFrame, children: Sequence[Sequence[str]], within: int, keys: Sequence[str] = KEY
) -> DataFrame:
    """Fires when the last child completes the listed order within the frame.

    Per child, the latest start of a chain that reaches it is a running maximum of
    the chains that reached the child before it at an earlier moment. The latest
    start is the best one, so no pairs of events are needed.
    """
    # The children seen at a moment are the bits of one number. As one column it is
    # carried whole, so that all steps of the chain share the first shuffle.
    bits = F.lit(0)
    for i, child in enumerate(children):
        bits = bits + F.when(is_expected(child), 1 << i).otherwise(0)
    moments = (
        events.withColumn("_bits", bits)
        .where(F.col("_bits") > 0)
        .groupBy(*keys, "ts")
        .agg(F.bit_or("_bits").alias("_bits"))
    )
    chain = sliced(moments, keys).withColumn("s0", F.expr("IF(_bits & 1 > 0, ts, NULL)"))
    for i in range(1, len(children)):
        chain = (
            running(chain, maxes={"_best": f"s{i - 1}"})
            .withColumn(f"s{i}", F.expr(f"IF(_bits & {1 << i} > 0, _best, NULL)"))
            .drop("_best")
        )
    start = F.col(f"s{len(children) - 1}")
    return chain.where(start >= F.col("ts") - seconds_before(within)).select(
        *keys, F.col("ts").alias("fired_at"), start.alias("started_at")
    )


def trigger_metric(
    metrics: DataFrame,
    metric: str,
    compare: str,
    threshold: float,
    lookback: int,
    firing_for: int,
    keys: Sequence[str] = ("run_id",),
) -> DataFrame:
    """Fires when the mean over the lookback has breached the threshold without a break
    for ``firing_for`` seconds; tested at every point of the metric.

    Means are of doubles, of any size. An infinite value makes the means of its own frames
    infinite; a mean that is not a number (NaN among the values, or both infinities) breaches nothing.
    """
    points = (
        metrics.where((F.col("metric") == metric) & F.col("value").isNotNull())
        .groupBy(*keys, "ts")
        .agg(F.count("*").alias("n"), F.sum(F.col("value").cast("double")).alias("s"))
    )
    framed = frame_sums(points, keys, ["n", "s"], lookback)
    mean = F.col("s_since") / F.col("n_since")
    breach = ~F.isnan("mean") & COMPARE[compare](F.col("mean"), F.lit(float(threshold)))
    tested = framed.select(*keys, "ts", mean.alias("mean")).withColumn("breach", breach)
    stepped = running(
        sliced(tested, keys), previous={"prev_breach": "breach", "prev_ts": "ts"}, places=sliced(points.select(*keys, "ts"), keys)
    )
    began = F.col("breach") & ~F.coalesce("prev_breach", F.lit(False))
    islands = running(
        stepped.withColumn("own_start", F.when(began, F.col("ts"))), maxes={"past_start": "own_start"}
    ).withColumn("since", F.coalesce("own_start", "past_start"))
    due = F.col("since") + seconds_before(firing_for)
    fired_before = F.coalesce(F.col("prev_breach") & (F.col("prev_ts") >= due), F.lit(False))
    return islands.where(F.col("breach") & (F.col("ts") >= due) & ~fired_before).select(
        *keys, F.col("ts").alias("fired_at"), F.col("since").alias("breach_since"), "mean"
    )
