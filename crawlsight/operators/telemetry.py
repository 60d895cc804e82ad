"""Analysis of exported metrics and spans."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .quantiles import exact_quantiles, quantile_name

# Names of the metrics and of the span phases.
HISTOGRAMS = (
    "event_loop.lag",
    "request.duration",
    "request.cpu_time",
    "db.lock.wait",
    "db.lock.hold",
    "compression.duration",
    "compression.ratio",
    "compaction.duration",
)
GAUGES = ("worker.active", "queue.pending")
REQUEST = "request"
PHASES = (
    "rate_limiter.gate",
    "transport.resolve",
    "continuation",
    "archive.lookup",
    "archive.download",
    "archive.upload",
    "compress",
)
ARCHIVE_PHASES = ("archive.lookup", "archive.download", "archive.upload")
SAMPLE_RATIO = 0.05
ALWAYS_ON = ("1", "1.0", "always_on", "on")

# Ours: the sample rule and the bucket bounds (seconds).
_HASH_FACTOR = 1_103_515_245
_HASH_RANGE = 2**32
BUCKET_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 1.0)
# Ours: p99 above which a signal counts as high (seconds).
THRESHOLDS = {"lag": 0.15, "cpu": 0.15, "client": 0.2, "lock": 0.15, "gate": 0.2}
QUANTILES = (0.5, 0.9, 0.99)


# The phases whose CPU time is spent on the loop.
BLOCKING_PHASES = ("compress", "continuation")


def metric_histograms(
    metrics: DataFrame, attributes: Sequence[str], probs: Sequence[float] = QUANTILES
) -> DataFrame:
    """Count, sum, range and quantiles of every histogram metric per attribute set."""
    points = metrics.where(F.col("metric").isin(*HISTOGRAMS))
    return exact_quantiles(points, ["metric", *attributes], "value", probs)


def metric_buckets(
    metrics: DataFrame, bounds: Sequence[float] = BUCKET_BOUNDS, attributes: Sequence[str] = ()
) -> DataFrame:
    """Cumulative counts per upper bound and attribute set; the last bound is open (NULL)."""
    points = metrics.where(F.col("metric").isin(*HISTOGRAMS))
    wide = points.groupBy("metric", *attributes).agg(
        *[F.count_if(F.col("value") <= bound).alias(f"b{i}") for i, bound in enumerate(bounds)],
        F.count("value").alias("b_open"),
    )
    edges = [
        F.struct(F.lit(float(bound)).alias("bound"), F.col(f"b{i}").alias("n"))
        for i, bound in enumerate(bounds)
    ]
    edges.append(F.struct(F.lit(None).cast("double").alias("bound"), F.col("b_open").alias("n")))
    return wide.select("metric", *attributes, F.inline(F.array(*edges)))


def gauge_last(metrics: DataFrame) -> DataFrame:
    """Latest value of each gauge series."""
    return (
        metrics.where(F.col("metric").isin(*GAUGES))
        .groupBy("metric", "scraper", "run_id")
        .agg(
            F.max_by("value", F.struct("ts", "value")).alias("value"),
            F.max("ts").alias("ts"),
        )
    )


def phase_breakdown(spans: DataFrame) -> DataFrame:
    """Seconds per phase and their share of the whole request, per source and step."""

    def seconds(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("name") == name, F.col("seconds"))), F.lit(0.0))

    wide = spans.groupBy("scraper", "step").agg(
        seconds(REQUEST).alias("total"), *[seconds(name).alias(name) for name in PHASES]
    )
    rows = [
        F.struct(
            F.lit(name).alias("phase"),
            F.col(f"`{name}`").alias("seconds"),
            F.try_divide(F.col(f"`{name}`"), F.col("total")).alias("share"),
        )
        for name in ("total", *PHASES)
    ]
    return wide.select("scraper", "step", F.inline(F.array(*rows)))


def archive_phase_compare(spans: DataFrame, probs: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Archive phases of the two backends side by side; ratio is local to object store."""
    points = spans.where(F.col("name").isin(*ARCHIVE_PHASES))
    stats = exact_quantiles(points, ["name", "backend"], "seconds", probs)
    columns = ["count", *[quantile_name(p) for p in probs]]

    def of(backend: str, column: str) -> Column:
        return F.max(F.when(F.col("backend") == backend, F.col(column))).alias(f"{column}_{backend}")

    side = stats.groupBy(F.col("name").alias("phase")).agg(
        *[of(backend, column) for column in columns for backend in ("s3", "local")]
    )
    first = quantile_name(probs[0])
    return side.withColumn("ratio", F.try_divide(F.col(f"{first}_local"), F.col(f"{first}_s3")))


def setting_compare(
    metrics: DataFrame, metric: str, setting: str, probs: Sequence[float] = QUANTILES
) -> DataFrame:
    """One metric by a worker setting. An empty setting is not a missing one."""
    return exact_quantiles(metrics.where(F.col("metric") == metric), [setting], "value", probs)


def loop_lag_by_mode(metrics: DataFrame, probs: Sequence[float] = QUANTILES) -> DataFrame:
    return setting_compare(metrics, "event_loop.lag", "run_pool", probs)


def run_correlation(spans: DataFrame, metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """Spans and metric points per run, with the run's source.

    Points without a run id stay together under a NULL run.
    """
    both = (
        spans.select("run_id", F.lit(1).alias("s"), F.col("seconds"), F.lit(0).alias("m"))
        .unionByName(
            metrics.select("run_id", F.lit(0).alias("s"), F.lit(0.0).alias("seconds"), F.lit(1).alias("m"))
        )
        .groupBy("run_id")
        .agg(F.sum("s").alias("spans"), F.sum("seconds").alias("seconds"), F.sum("m").alias("points"))
    )
    return both.join(runs.select("run_id", "source_path", "schema"), "run_id", "left")


def with_run(points: DataFrame, runs: DataFrame) -> DataFrame:
    """Every point with its run's source; points without a known run keep NULLs.

    A missing run id is replaced by one that matches nothing and differs by row
    (the trace it belongs to), so the unmatched rows spread over all tasks.
    """
    side = runs.select(F.col("run_id").alias("_run"), "source_path", "schema")
    join_key = F.coalesce("run_id", F.concat(F.lit("none "), F.col("trace_id").cast("string")))
    return points.withColumn("_run", join_key).join(side, "_run", "left").drop("_run")


def span_tree(spans: DataFrame) -> DataFrame:
    """Depth below the root and self time (duration minus that of the children).

    A parent that is not in the data counts as a root; spans on a cycle, and below one, have no depth (NULL).
    """
    children = (
        spans.where(F.col("parent_id").isNotNull())
        .groupBy("trace_id", F.col("parent_id").alias("span_id"))
        .agg(F.sum("seconds").alias("child_seconds"))
    )
    times = spans.join(children, ["trace_id", "span_id"], "left").select(
        "trace_id",
        "span_id",
        "name",
        (F.col("seconds") - F.coalesce("child_seconds", F.lit(0.0))).alias("self_seconds"),
        "parent_id",
    )
    return _below_parents(times, _parent_depths(spans))


def span_depths(spans: DataFrame) -> DataFrame:
    """(trace_id, span_id, depth) by the rules of :func:`span_tree`."""
    return _below_parents(spans.select("trace_id", "span_id", "parent_id"), _parent_depths(spans))


def _below_parents(spans: DataFrame, parents: DataFrame) -> DataFrame:
    """Put the depth in place of ``parent_id``, one below the parent's. Roots take no part in the join."""
    own = [name for name in spans.columns if name != "parent_id"]
    roots = spans.where(F.col("parent_id").isNull()).select(*own, F.lit(0).alias("depth"))
    above = parents.select("trace_id", F.col("span_id").alias("parent_id"), F.col("depth").alias("above"), F.lit(True).alias("found"))
    below = spans.where(F.col("parent_id").isNotNull()).join(above, ["trace_id", "parent_id"], "left")
    depth = F.when(F.col("found"), F.col("above") + 1).otherwise(0)
    return roots.unionByName(below.select(*own, depth.alias("depth")))


def _parent_depths(spans: DataFrame) -> DataFrame:
    """(trace_id, span_id, depth) of the spans that have children; most spans have none and wait for the last join.

    Each round replaces a span's ancestor by that ancestor's own, so a span at depth d is done after log2(d) rounds.
    A round writes the spans that are still open and no other. If it finishes none, what is left hangs on parents that
    form a cycle. Of spans with one id, the least parent counts.
    """
    ensure_checkpoint_dir(spans.sparkSession)
    asked = spans.where(F.col("parent_id").isNotNull()).select("trace_id", F.col("parent_id").alias("span_id")).distinct()
    ups = spans.groupBy("trace_id", "span_id").agg(F.min("parent_id").alias("up"))
    inner = ups.join(asked, ["trace_id", "span_id"], "left_semi")
    step = inner.select("trace_id", "span_id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("depth")).checkpoint()
    done, before = [], None
    while True:
        done.append(step.where(F.col("up").isNull()))
        step = step.where(F.col("up").isNotNull())
        left = step.count()
        if left in (0, before):
            done.append(step.withColumn("depth", F.lit(None).cast("int")))
            return reduce(DataFrame.unionByName, done).select("trace_id", "span_id", "depth")
        before = left
        above = reduce(DataFrame.unionByName, [*done, step]).select(
            "trace_id",
            F.col("span_id").alias("up"),
            F.col("up").alias("next_up"),
            F.col("depth").alias("more"),
            F.lit(True).alias("found"),
        )
        # A parent that is not in the data: its child is a root.
        step = (
            step.join(above, ["trace_id", "up"], "left")
            .select(
                "trace_id",
                "span_id",
                F.col("next_up").alias("up"),
                F.when(F.col("found"), F.col("depth") + F.col("more")).otherwise(F.col("depth") - 1).alias("depth"),
            )
            .checkpoint()
        )


def sample_ratio(setting: str | None) -> float:
    """The share of traces to keep, from a setting's text."""
    text = str(SAMPLE_RATIO) if setting is None else setting.strip().lower()
    if text in ALWAYS_ON:
        return 1.0
    try:
        ratio = float(text)
    except ValueError:
        return SAMPLE_RATIO
    return ratio if math.isfinite(ratio) and 0.0 <= ratio <= 1.0 else SAMPLE_RATIO


def trace_sample(spans: DataFrame, ratio: float = SAMPLE_RATIO) -> DataFrame:
    """Whole traces, chosen by their id: all spans of a trace get one answer, without a join."""
    hashed = F.pmod(F.pmod(F.col("trace_id"), F.lit(_HASH_RANGE)) * F.lit(_HASH_FACTOR), F.lit(_HASH_RANGE))
    return spans.where(hashed < F.lit(int(ratio * _HASH_RANGE)))


def bottleneck_diagnosis(
    metrics: DataFrame, spans: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS
) -> DataFrame:
    """What limits each run, by the p99 of five signals and four ordered rules.

    CPU time is that of the phases which block the loop. A signal without data counts as low.
    """
    signal = {
        "event_loop.lag": "lag",
        "request.cpu_time": "cpu",
        "db.lock.wait": "lock",
        "rate_limiter.gate": "gate",
        "transport.resolve": "client",
    }
    names = F.create_map(*[F.lit(x) for pair in signal.items() for x in pair])
    blocking = (F.col("metric") == "request.cpu_time") & F.col("phase").isin(*BLOCKING_PHASES)
    points = (
        metrics.where(F.col("metric").isin("event_loop.lag", "db.lock.wait") | blocking)
        .select("run_id", F.col("metric").alias("name"), "value")
        .unionByName(
            spans.select("run_id", "name", F.col("seconds").alias("value")).where(
                F.col("name").isin("rate_limiter.gate", "transport.resolve")
            )
        )
        .where(F.col("run_id").isNotNull())
        .withColumn("signal", names[F.col("name")])
    )
    stats = exact_quantiles(points, ["run_id", "signal"], "value", (0.99,))
    wide = stats.groupBy("run_id").agg(
        *[
            F.coalesce(F.max(F.when(F.col("signal") == name, F.col("p99"))), F.lit(0.0)).alias(name)
            for name in signal.values()
        ]
    )

    def high(name: str) -> Column:
        return F.col(name) > F.lit(float(thresholds[name]))

    label = (
        F.when(high("lag") & high("cpu") & ~high("client"), "cpu_saturated")
        .when(~high("lag") & high("lock"), "db_lock_bound")
        .when(~high("lag") & ~high("lock") & high("gate"), "rate_limited")
        .when(~high("lag") & ~high("lock") & ~high("gate") & ~high("cpu"), "io_bound")
        .otherwise("unclear")
    )
    return wide.withColumn("diagnosis", label)
