"""Exact quantiles of groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in the memory of one
task. Here equal values are counted first, the value axis is cut into slices whose
totals tell which slice holds a wanted rank, and only those slices are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Slices per factor of e (neighbours differ by 0.2 %), for values from a billionth up.
# The slice never falls as the value grows; NaN counts as the largest value. The outer
# coalesce only tells Spark that a slice is never NULL: else the join below would filter
# one of its sides, and the shuffle that both sides share would run twice.
VALUE_SLICE = """coalesce(CASE WHEN isnan(_v) THEN 2147483648
  WHEN _v < 0 THEN -floor(log1p(least(-_v, 1e290) / 1e-9) * 512) - 1
  ELSE floor(log1p(least(_v, 1e290) / 1e-9) * 512) END, 0)"""


def quantile_name(p: float) -> str:
    return "p" + f"{p * 100:g}".replace(".", "_")


def exact_quantiles(
    rows: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], copies: str | None = None
) -> DataFrame:
    """Count, sum, min, max and interpolated quantiles of ``value`` per group.

    A row stands for one value, or for as many as its column ``copies`` says. Missing values are not counted. Quantiles interpolate between neighbours.
    """
    counts = (
        rows.where(F.col(value).isNotNull())
        .select(
            F.struct(*keys).alias("_key"),
            F.col(value).cast("double").alias("_v"),
            (F.col(copies) if copies else F.lit(1)).cast("long").alias("_copies"),
        )
        .groupBy("_key", "_v")
        .agg(F.sum("_copies").alias("_n"))
        .withColumn("_slice", F.expr(VALUE_SLICE))
    )
    totals = counts.groupBy("_key", "_slice").agg(
        F.expr("sum(_n) AS _n"),
        F.expr("sum(_v * _n) AS _sum"),
        F.expr("min(_v) AS _min"),
        F.expr("max(_v) AS _max"),
    )
    group = "OVER (PARTITION BY _key)"
    along = "OVER (PARTITION BY _key ORDER BY _slice ROWS UNBOUNDED PRECEDING)"
    placed = totals.selectExpr(
        "_key",
        "_slice",
        f"sum(_n) {along} - _n AS _from",
        f"sum(_n) {along} AS _to",
        f"sum(_n) {group} AS count",
        f"sum(_sum) {group} AS sum",
        f"min(_min) {group} AS min",
        f"max(_max) {group} AS max",
    )

    # Rows _from .. _to - 1 of a group, in order of value, are the ones at hand.
    position = [f"((count - 1) * {float(p)!r}D)" for p in probs]
    low = [f"(floor({at}) >= _from AND floor({at}) < _to)" for at in position]
    high = [f"(ceil({at}) >= _from AND ceil({at}) < _to)" for at in position]
    any_rank = " OR ".join(low + high)

    inside = "OVER (PARTITION BY _key, _slice ORDER BY _v ROWS UNBOUNDED PRECEDING)"
    near = (
        counts.join(placed.where(any_rank).drop("_to"), ["_key", "_slice"])
        .selectExpr("*", f"_from + sum(_n) {inside} AS _to")
        .selectExpr("_key", "_v", "count", "sum", "min", "max", "_to - _n AS _from", "_to")
        .where(any_rank)
    )
    picks = [F.expr(f"max(IF({hit}, _v, NULL)) AS _low{i}") for i, hit in enumerate(low)]
    picks += [F.expr(f"max(IF({hit}, _v, NULL)) AS _high{i}") for i, hit in enumerate(high)]
    stats = ["count", "sum", "min", "max"]
    found = near.groupBy("_key").agg(*[F.expr(f"first({name}) AS {name}") for name in stats], *picks)
    return found.selectExpr(
        *[f"_key.{key} AS {key}" for key in keys],
        *stats,
        *[
            # Equal neighbours need no step between them; infinite ones have none.
            f"IF(_low{i} = _high{i}, _low{i}, _low{i} + (_high{i} - _low{i}) * ({at} - floor({at}))) AS {quantile_name(p)}"
            for i, (p, at) in enumerate(zip(probs, position))
        ],
    )
