"""Running values along time that never put one key into one task.

A plain window over a key sorts all rows of that key in one task. Here time is
cut into slices: the window runs inside (key, slice), and a second, small window
carries each slice's outcome on to the slices after it. That second window sees
one row per slice of a key, so its size follows the length of the history and
not the number of rows.

A slice in which very much happens is cut again where the data are. Sampled rows are its splitters: those
whose hash says so, one in ``SLICE_ROWS``, but no more than the ``SPLITTERS`` of least hash. A row's part is the
number of splitters up to it, which it finds by binary search. So every part has about ``SLICE_ROWS`` rows (or
one in ``SPLITTERS`` of the table) even if all rows are of one key and one second, and splitters, the only
thing that is broadcast, are bounded whatever the input.

Input must hold at most one row per key, time and tie-breaking columns: add up equal ones first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_SECONDS = 300  # for dense event streams
SLICE_ROWS = 50_000
SPLITTERS = 65_536
FRAME_BLOCKS = 1000
NO_TIME = -(2**62)
HISTORY_SLICE = 86_400  # for run histories, which span years


def sliced(
    rows: DataFrame, keys: Sequence[str], ts: str = "ts", slice_seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Add the key and slice columns that :func:`running` works on.

    The key is one struct, so that NULL keys meet each other in joins. Rows without
    a time share a slice before all others; as no slice is NULL, Spark adds no
    filter to the join in ``running`` and both its sides share one shuffle.
    """
    return rows.selectExpr(
        "*",
        f"struct({', '.join(keys)}) AS _key",
        f"unix_micros({ts}) AS _at",
        f"coalesce(floor(unix_micros({ts}) / {slice_seconds * 1_000_000}), {NO_TIME}) AS _slice",
    )


def parted(rows: DataFrame, ties: Sequence[str] = (), places: DataFrame | None = None) -> DataFrame:
    """Sliced rows with ``_part``: which part of its slice a row lies in, in order of time and ``ties``.

    Splitters are drawn from ``places`` where given: sliced rows of the same moments that cost less to make.

    Splitters follow from values alone, so a repeated task cuts as the first one did. Rows of one
    moment are told apart by ``ties`` only; without any they share a part.
    """
    place = f"struct({', '.join(['_at', *ties])})"
    drawn = (rows if places is None else places).select("_key", "_slice", F.expr(place).alias("_place"), F.xxhash64("_key", F.expr(place)).alias("_drawn"))
    drawn = drawn.where(F.pmod("_drawn", F.lit(SLICE_ROWS)) == 0).orderBy("_drawn").limit(SPLITTERS)
    splitters = drawn.groupBy("_key", "_slice").agg(F.sort_array(F.collect_set("_place")).alias("_splitters"))
    # A step of the search looks half as far as the one before; a slice has fewer than 2 ** 20 splitters.
    steps = ", ".join(str(1 << i) for i in reversed(range(20)))
    search = f"""aggregate(array({steps}), 0,
        (found, hop) -> IF(found + hop <= size(_splitters) AND get(_splitters, found + hop - 1) <= {place}, found + hop, found))"""
    found = rows.join(F.broadcast(splitters), ["_key", "_slice"], "left")
    return found.withColumn("_part", F.expr(f"IF(_splitters IS NULL, 0, {search})")).select(*rows.columns, "_part")


def running(
    rows: DataFrame,
    sums: Mapping[str, str] | None = None,
    maxes: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    ties: Sequence[str] = (),
    places: DataFrame | None = None,
) -> DataFrame:
    """Add running columns to sliced rows, in order of time and ``ties``.

    ``sums`` run up to and including the row, ``maxes`` over the rows before it,
    ``previous`` is the value on the row before it. All map new to old names. The parts stay
    with the rows, for further scans of them.
    """
    sums, maxes, previous = dict(sums or {}), dict(maxes or {}), dict(previous or {})
    if "_part" not in rows.columns:
        rows = parted(rows, ties, places)
    order = ", ".join(["_at", *ties])
    latest = f"struct({order})" if ties else "_at"
    outcome = [f"sum({old}) AS _t_{new}" for new, old in sums.items()]
    outcome += [f"max({old}) AS _t_{new}" for new, old in maxes.items()]
    outcome += [f"max_by({old}, {latest}) AS _t_{new}" for new, old in previous.items()]
    totals = rows.groupBy("_key", "_slice", "_part").agg(*map(F.expr, outcome))

    along = "OVER (PARTITION BY _key ORDER BY _slice, _part{})"
    before = along.format(" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    carried = [f"sum(_t_{new}) {before} AS _c_{new}" for new in sums]
    carried += [f"max(_t_{new}) {before} AS _c_{new}" for new in maxes]
    carried += [f"lag(_t_{new}) {along.format('')} AS _c_{new}" for new in previous]
    joined = rows.join(totals.selectExpr("_key", "_slice", "_part", *carried), ["_key", "_slice", "_part"])

    inside = f"OVER (PARTITION BY _key, _slice, _part ORDER BY {order}{{}})"
    up_to = inside.format(" ROWS UNBOUNDED PRECEDING")
    earlier = inside.format(" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    here = inside.format("")
    added = [f"coalesce(_c_{new}, 0) + sum({old}) {up_to} AS {new}" for new, old in sums.items()]
    added += [f"greatest(_c_{new}, max({old}) {earlier}) AS {new}" for new, old in maxes.items()]
    added += [
        f"IF(row_number() {here} = 1, _c_{new}, lag({old}) {here}) AS {new}"
        for new, old in previous.items()
    ]
    return joined.selectExpr(*rows.columns, *added)


def unsliced(rows: DataFrame) -> DataFrame:
    return rows.drop("_key", "_at", "_slice", "_part")


def frame_sums(
    points: DataFrame, keys: Sequence[str], amounts: Sequence[str], seconds: int, ts: str = "ts", blocks: int = FRAME_BLOCKS
) -> DataFrame:
    """Sums of ``amounts`` over [ts - seconds, ts] at every point, for numbers of any size.

    ``points`` holds one row per key and time. A frame is as long as ``blocks`` blocks of time: the end of one, those
    between, and the beginning of another. The outer two are sums from a block's edge, taken inside the
    block; those between are sums of whole blocks (:func:`_between`). So no task sees a whole frame, and as nothing is
    subtracted, no value outside of a frame has a part in it. Frames under a minute are one block long.
    """
    blocks = blocks if seconds >= 60 else 1
    kinds = {field.name: field.dataType.simpleString() for field in points.schema.fields}
    zeros = "".join(f", CAST(0 AS {kinds[name]}) AS {name}" for name in amounts)
    own = "".join(f", {name}" for name in amounts)
    probe = f", struct(unix_micros({ts}) - {seconds} * 1000000L AS _at, -1 AS _side{zeros})" if seconds else ""
    # A thousand blocks divide any number of seconds into whole microseconds.
    block = f"floor(_at / {max(seconds, 1) * 1_000_000 // blocks})"
    both = points.selectExpr(
        f"struct({', '.join(keys)}) AS _key", f"{ts} AS _anchor", f"inline(array(struct(unix_micros({ts}) AS _at, 1 AS _side{own}){probe}))"
    ).withColumn("_slice", F.expr(block))
    # At one moment the mark comes before the probe, so that the frame's edge is inside.
    inside = "OVER (PARTITION BY _key, _slice ORDER BY {} ROWS UNBOUNDED PRECEDING)"
    begun, left = inside.format("_at, _side"), inside.format("_at DESC, _side DESC")
    if not seconds:
        begun = "OVER (PARTITION BY _key, _at)"
    sums = [f"IF(_side = 1, sum({name}) {begun}, sum({name}) {left}) AS _part_{name}" for name in amounts]
    parts = both.selectExpr("_key", "_anchor", "_slice", "_side", *sums)
    if blocks > 1:
        whole = points.selectExpr(f"struct({', '.join(keys)}) AS _key", f"unix_micros({ts}) AS _at", *amounts)
        whole = whole.groupBy("_key", F.expr(block).alias("_slice")).agg(*[F.sum(name).alias(name) for name in amounts])
        parts = parts.join(_between(whole, amounts, blocks), ["_key", "_slice"], "left").withColumns(
            {f"_part_{name}": F.expr(f"IF(_side = 1, _part_{name} + coalesce(_mid_{name}, 0), _part_{name})") for name in amounts}
        )
    return (
        parts.groupBy("_key", "_anchor")
        .agg(*[F.sum(f"_part_{name}").alias(f"{name}_since") for name in amounts])
        .selectExpr(*[f"_key.{key} AS {key}" for key in keys], f"_anchor AS {ts}", *[f"{name}_since" for name in amounts])
    )


def _between(whole: DataFrame, amounts: Sequence[str], blocks: int) -> DataFrame:
    """For each block of (_key, _slice, amounts) the sums of the ``blocks - 1`` blocks before it, as ``_mid_``: those that
    lie whole in the frames which end in it.

    So many blocks are the end of one group of as many blocks and the beginning of the next, or one whole group; again
    both are sums from the edge of a group, and nothing is subtracted.
    """
    size = blocks - 1
    zeros = "".join(f", CAST(0 AS {field.dataType.simpleString()}) AS {field.name}" for field in whole.schema.fields if field.name in amounts)
    own = "".join(f", {name}" for name in amounts)
    last, first = "_slice - 1", f"_slice - {size}"
    rows = f"array(struct(_slice AS _at, 0 AS _side{own}), struct({last} AS _at, 1 AS _side{zeros}), struct({first} AS _at, -1 AS _side{zeros}))"
    moved = whole.selectExpr("_key", "_slice AS _end", f"inline({rows})").withColumn("_group", F.expr(f"floor(_at / {size})"))
    along = "OVER (PARTITION BY _key, _group ORDER BY {} ROWS UNBOUNDED PRECEDING)"
    up_to, from_ = along.format("_at, _side"), along.format("_at DESC, _side DESC")
    # One whole group is counted by its end alone.
    twice = f"_side = -1 AND floor((_end - 1) / {size}) = _group"
    sums = [f"CASE WHEN _side = 1 THEN sum({name}) {up_to} WHEN {twice} THEN NULL ELSE sum({name}) {from_} END AS _mid_{name}" for name in amounts]
    told = moved.selectExpr("_key", "_end", "_side", *sums).where("_side <> 0")
    return told.groupBy("_key", F.col("_end").alias("_slice")).agg(*[F.sum(f"_mid_{name}").alias(f"_mid_{name}") for name in amounts])


def since(
    points: DataFrame,
    keys: Sequence[str],
    amounts: Sequence[str],
    seconds: int,
    ts: str = "ts",
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Sums of ``amounts`` over [ts - seconds, ts] at every point.

    ``points`` holds one row per key and time. A sliding frame would add up its
    rows again at every step; here each sum is the difference of two running
    sums, the second taken by a probe row at ``ts - seconds``. Amounts must be
    integers or decimals, so that the differences are exact.
    """
    kinds = {field.name: field.dataType.simpleString() for field in points.schema.fields}
    zeros = "".join(f", CAST(0 AS {kinds[name]}) AS {name}" for name in amounts)
    own = "".join(f", {name}" for name in amounts)
    # A probe stands before a mark of the same time, so that the frame's edge is inside.
    mark = f"struct({ts} AS {ts}, 1 AS _side{own})"
    probe = f"struct({ts} - INTERVAL '{seconds}' SECOND AS {ts}, -1 AS _side{zeros})"
    both = points.selectExpr(*keys, f"{ts} AS _anchor", f"inline(array({mark}, {probe}))")
    scanned = running(
        sliced(both, keys, ts, slice_seconds),
        sums={f"_r_{name}": name for name in amounts},
        ties=["_side"],
    )
    return scanned.groupBy(*keys, F.col("_anchor").alias(ts)).agg(
        *[F.expr(f"sum({name}) AS {name}") for name in amounts],
        *[F.expr(f"sum(_r_{name} * _side) AS {name}_since") for name in amounts],
    )
