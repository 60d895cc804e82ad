"""Mixing sources to target weights by Pfair scheduling.

A source is a queue of blocks of equal size, and every slot holds one block. A queue's line says how many blocks it is due
at any slot: it rises by the queue's weight, and when a queue has ended the others share its weight in proportion. All lines
together rise by one block a slot. A block is released at the last slot at which the line has not passed its beginning, and is due
at the first at which the line has reached its end; a slot goes to the released block that is due first. Each block gets a slot
within its window, so that a queue is off its line by less than one block, before every slot.

Lines are whole numbers, a few per queue and end of a queue, and give the window of any block. The walk along the slots is cut
into periods: a first walk, ``TOGETHER`` periods a job, keeps only how many blocks each queue has had at the period's edges,
and then each period is scheduled by a task of its own. A slot stands for a whole block, so documents are never walked.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

# The queue of all sources beyond the ``most_queues`` of most weight; no source has a name like it.
OTHERS = "\x00others"
# Documents in one slice of a queue, about: the unit that is sorted in one task.
SLICE = 4096


# Weights are whole numbers of this unit, so that products of two stay within 64 bits.
UNIT = 1 << 30
# Slots in a period, the unit that a task schedules, and periods in one job of the walk that finds their edges.
PERIOD, TOGETHER = 4096, 16
LINES = "one int, q array<struct<queue: string, blocks: long, line: array<struct<slot: long, at: long, share: long>>>>"
SCHEDULE = "queue string, share long, whole long, steps array<struct<own: long, whole: long, left: boolean>>"


def _shared(weights: list[float], units: int) -> list[int]:
    """``units`` in proportion to ``weights``, one at least to each; the largest takes what rounding leaves."""
    total = sum(weights)
    if not total > 0:
        weights, total = [1.0] * len(weights), float(len(weights))
    shares = [max(1, int(weight / total * units)) for weight in weights]
    while over := sum(shares) - units:
        largest = max(shares)
        shares[shares.index(largest)] -= min(over, largest - 1)
    return shares


def lines(weights: list[float], blocks: list[int]) -> list[list[tuple[int, int, int]]]:
    """Each queue's line as (slot, at, share): from ``slot`` on it rises from ``at`` by ``share`` a slot, in UNITs of a block.

    A row for the beginning and at most two for each queue's end: the last slot of a queue may be due less than
    its share, and then the others take the rest of that slot.
    """
    rest = [count * UNIT for count in blocks]
    found: list[list[tuple[int, int, int]]] = [[] for _ in blocks]
    slot = 0
    while any(rest):
        alive = [i for i, left in enumerate(rest) if left]
        share = dict(zip(alive, _shared([weights[i] for i in alive], UNIT)))
        slots = min(rest[i] // share[i] for i in alive)
        if slots == 0:
            slots, ending = 1, {}
            while over := [i for i in share if share[i] > rest[i]]:
                ending |= {i: rest[i] for i in over}
                others = [i for i in share if i not in over]
                share = dict(zip(others, _shared([weights[i] for i in others], UNIT - sum(ending.values()))))
            share |= ending
        for i in alive:
            found[i].append((slot, blocks[i] * UNIT - rest[i], share[i]))
            rest[i] -= slots * share[i]
            if not rest[i]:
                found[i].append((slot + slots, blocks[i] * UNIT, 0))
        slot += slots
    return found


def _ceil(a: str, b: str) -> str:
    return f"(({a} + {b} - 1) div {b})"


def _windows() -> Column:
    """Of a row's queues ``q``, which have had ``next`` blocks: release and deadline of all blocks that can have a slot before ``b``."""
    released = f"get(transform(array(element_at(filter(c.line, p -> p.slot <= b), -1)), p -> {_ceil('p.at + p.share * (b - p.slot)', f'{UNIT}L')}), 0)"
    release = f"get(transform(array(element_at(filter(c.line, p -> p.at <= k * {UNIT}L), -1)), p -> p.slot + (k * {UNIT}L - p.at) div p.share), 0)"
    due = f"get(transform(array(element_at(filter(c.line, p -> p.at < (k + 1) * {UNIT}L), -1)), p -> p.slot + {_ceil(f'(k + 1) * {UNIT}L - p.at', 'p.share')}), 0)"
    window = f"named_struct('block', k, 'release', {release}, 'deadline', {due})"
    # A line ends at the queue's last block, so none beyond is released.
    blocks = f"IF({released} > next[i], sequence(next[i], {released} - 1), cast(array() AS array<bigint>))"
    return F.expr(f"transform(q, (c, i) -> transform({blocks}, k -> {window}))")


# The queue that has slot t, where the queues have had p blocks of their windows w: released, and due first.
_TURN = "array_min(transform(w, (x, i) -> IF(get(x, p[i]).release <= t, named_struct('deadline', get(x, p[i]).deadline, 'i', i), NULL))).i"
_NONE_YET = "transform(w, x -> 0)"
_SERVED = "transform(p, (n, i) -> IF(i = f, n + 1, n))"


def slots(
    spark: SparkSession, weights: dict[str, float], blocks: dict[str, int], period: int = PERIOD, together: int = TOGETHER
) -> DataFrame:
    """queue, block, slot, release, deadline: earliest deadline first, one row per block; slots are gapless.

    ``weights`` are in any proportion, as given to one part in UNIT; the least share is one of UNIT while another queue has
    weight. ``blocks`` has every queue's number of blocks. The result does not depend on ``period`` and ``together``.
    """
    names = sorted(blocks)
    drawn = lines([weights[name] for name in names], [blocks[name] for name in names])
    q = spark.createDataFrame([(0, [(name, blocks[name], line) for name, line in zip(names, drawn)])], LINES)
    whole, starts = sum(blocks.values()), "one int, a long, b long, next array<long>"

    def windows(rows: list[tuple]) -> DataFrame:
        # One row, of a few numbers per queue and end of a queue.
        return spark.createDataFrame(rows, starts).join(F.broadcast(q), "one").withColumn("w", _windows())

    inner = f"aggregate(sequence(a + j * {period}, least(a + (j + 1) * {period}, b) - 1), s.p, (p, t) -> get(transform(array({_TURN}), f -> {_SERVED}), 0))"
    edges = f"""aggregate(sequence(0L, {_ceil("b - a", str(period))} - 1), named_struct('p', {_NONE_YET}, 'edges', array({_NONE_YET})),
        (s, j) -> get(transform(array({inner}), x -> named_struct('p', x, 'edges', concat(s.edges, array(x)))), 0)).edges"""
    served, periods = [0] * len(names), []
    for a in range(0, whole, period * together):
        b = min(whole, a + period * together)
        # A row per job, of a number per queue and period.
        found = windows([(0, a, b, served)]).select(F.expr(edges).alias("edges")).first().edges
        states = [[n + more for n, more in zip(served, edge)] for edge in found]
        periods += [(0, at, min(b, at + period), state) for at, state in zip(range(a, b, period), states)]
        served = states[-1]
    turn = f"get(transform(array({_TURN}), f -> named_struct('p', {_SERVED}, 'order', array_append(s.order, named_struct('i', f, 'window', get(w[f], p[f]))))), 0)"
    none = "cast(array() AS array<struct<i: int, window: struct<block: bigint, release: bigint, deadline: bigint>>>)"
    order = f"aggregate(sequence(a, b - 1), named_struct('p', {_NONE_YET}, 'order', {none}), (s, t) -> get(transform(array(s.p), p -> {turn}), 0)).order"
    rows = windows(periods).select("a", "q", F.posexplode(F.expr(order)).alias("n", "turn"))
    return rows.select(
        F.expr("q[turn.i].queue").alias("queue"), "turn.window.block", (F.col("a") + F.col("n")).alias("slot"),
        "turn.window.release", "turn.window.deadline",
    )


def schedule(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    """SCHEDULE: each queue's share of ``whole`` and its way to the root of a Huffman tree; a row per queue.

    A plainer rule than ``slots``, for queues without end, and not used by ``mix``: of the first n slots of a node, its left child gets
    n * weight / (weight of the node), rounded to the nearest, so that ``slot_of`` needs no walk. A queue is off its share by less than 1.68 blocks.
    ``weights`` are in any proportion. The least share is one of UNIT; a queue of weight 0 has it.
    """
    total = sum(weights.values()) or 1.0
    shares = {queue: max(1, round(weight / total * UNIT)) for queue, weight in sorted(weights.items())}
    steps: dict[str, list[tuple[int, int, bool]]] = {queue: [] for queue in shares}
    nodes = [(share, i, [queue]) for i, (queue, share) in enumerate(shares.items())]
    heapq.heapify(nodes)
    for i in range(len(nodes), 2 * len(nodes) - 1):
        (a, _, left), (b, _, right) = heapq.heappop(nodes), heapq.heappop(nodes)
        for own, queues in ((a, left), (b, right)):
            for queue in queues:
                steps[queue].append((own, a + b, queues is left))
        heapq.heappush(nodes, (a + b, i, left + right))
    whole = sum(shares.values())
    return spark.createDataFrame([(queue, share, whole, steps[queue]) for queue, share in shares.items()], SCHEDULE)


def _scaled(x: Column, times: Column, by: Column) -> tuple[Column, Column]:
    """Floor and remainder of x * times / by, for large x."""
    div = lambda a, b: F.call_function("div", a, b)
    rest = (x % by) * times
    return div(x, by) * times + div(rest, by), rest % by


def slot_of(block: Column) -> Column:
    """The slot of a block of the queue whose SCHEDULE is in the row. ``mix`` has its slots from ``slots``."""

    def up(place: Column, step: Column) -> Column:
        low, rest = _scaled(place * 2 + 1, step["whole"], step["own"] * 2)
        return low - F.when(step["left"] & (rest == 0), 1).otherwise(0).cast("long")

    return F.aggregate("steps", block.cast("long"), up)


def window_of(block: Column) -> tuple[Column, Column]:
    """The first slot that a block may have and the first that it may not: 7/4 blocks around its queue's share."""
    low, _ = _scaled(block * 4 - 3, F.col("whole"), F.col("share") * 4)
    high, rest = _scaled(block * 4 + 7, F.col("whole"), F.col("share") * 4)
    return F.greatest(F.lit(0).cast("long"), low), high + F.when(rest > 0, 1).otherwise(0)


def slots_per_period(queues: DataFrame, weight: Column, period: int) -> DataFrame:
    """queue and k: how many of ``period`` slots each queue gets, one at least, all slots together.

    For a pattern that is repeated, see ``pattern``; ``mix`` does without, as rounded shares drift off their targets.
    Shares are rounded by largest remainder. The table has a row per queue, far fewer than slots.
    """
    everything = Window.partitionBy(F.lit(1))
    # One slot each comes first; the others are divided by weight.
    free = F.lit(period) - F.count(F.lit(1)).over(everything)
    share = weight.cast("double") / F.sum(weight.cast("double")).over(everything) * free
    whole = queues.select("queue", F.floor(share).alias("whole"), (share - F.floor(share)).alias("rest"), free.alias("free"))
    left = F.col("free") - F.sum("whole").over(everything)
    ranked = F.row_number().over(everything.orderBy(F.desc("rest"), "queue"))
    return whole.select("queue", (1 + F.col("whole") + F.when(ranked <= left, 1).otherwise(0)).cast("int").alias("k"))


def pattern(shares: DataFrame, period: int) -> DataFrame:
    """queue, k, turn, slot: the slots of one period by earliest deadline first; ``period`` rows.

    ``shares`` (queue, k) is small; its rows meet in one array, over which the slots are folded.
    """
    one = shares.agg(F.array_sort(F.collect_list(F.struct("queue", "k"))).alias("q"))
    none = F.array().cast("array<int>")

    def slot(state: Column, t: Column) -> Column:
        turn = lambda j: F.element_at(state["turns"], j)
        size = lambda j: F.element_at(F.col("q"), j)["k"]
        released = F.filter(
            F.sequence(F.lit(1), F.size("q")),
            lambda j: (turn(j) < size(j)) & (F.floor(turn(j) * period / size(j)) <= t),
        )
        first = F.array_min(
            F.transform(released, lambda j: F.struct(F.ceil((turn(j) + 1) * period / size(j)).alias("deadline"), j.alias("j")))
        )["j"]
        return F.struct(
            F.transform(state["turns"], lambda n, i: F.when(i + 1 == first, n + 1).otherwise(n)).alias("turns"),
            F.array_append(state["served"], first.cast("int")).alias("served"),
        )

    start = F.struct(F.transform("q", lambda _: F.lit(0)).alias("turns"), none.alias("served"))
    served = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, slot, lambda s: s["served"])
    rows = one.where(F.size("q") > 0).select("q", F.posexplode(served).alias("slot", "j"))
    rows = rows.select(F.element_at("q", F.col("j")).alias("cell"), "slot").select("cell.queue", "cell.k", "slot")
    by_slot = Window.partitionBy("queue").orderBy("slot")
    return rows.withColumn("turn", F.row_number().over(by_slot) - 1)


def targets(docs: DataFrame, exponent: float = 0.7, text: str = "text", source: str = "source") -> DataFrame:
    """source, weight: the default target of each source, its characters to the power ``exponent``. NULL sources are ''."""
    name = F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")
    rows = docs.select(name, F.coalesce(F.length(text), F.lit(0)).cast("long").alias("size"))
    return rows.groupBy("source").agg(lifted(F.sum("size"), exponent).alias("weight"))


def lifted(total: Column, exponent: float) -> Column:
    """The weight of so many characters; a source without any has one too."""
    return F.pow(total + 1, exponent)


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    exponent: float = 0.7,
    block: int = 65536,
    period: int = PERIOD,
    most_queues: int = 256,
    seed: int = 0,
    keep: tuple[str, ...] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Give every document its slot: ``keep``, queue, start, block, slot, release, deadline.

    A queue's documents stand in random order (by hash of id and ``seed``); ``start`` is the number of
    characters before a document, ``block`` the block it starts in (``block`` characters each).
    Reading all documents by (slot, start) gives the mixture. ``weights`` names the target shares of
    sources (one that is not named has the least share, one of UNIT); without it a source weighs its characters
    to the power ``exponent``, which lifts small sources. The targets hold until the first queue has
    ended; the others then share its weight in proportion. Before every slot, a queue is off its target by less
    than one block: slot lies from ``release`` to before ``deadline`` (see ``slots``). ``period`` is the number of slots
    that one task schedules; it does not bear on the result.

    Every document is kept. The ``most_queues`` sources of most weight have a queue each. All others share
    one, which weighs what they weigh together, so that the schedule is small whatever the number of
    sources; within it they stand in random order, by their sizes and not by their weights. NULL sources are one source,
    NULL texts are empty, NULL ids are put in by the hash of NULL. Repeated rows stay and follow
    each other. An empty table gives no rows. Other columns do not matter unless ``keep`` names them.
    """
    timed = _timed(docs, keep, weights, exponent, block, period, most_queues, seed, doc_id, text, source)
    return timed.select("row.*", "queue", "start", "block", "slot", "release", "deadline")


def _timed(docs, keep, weights, exponent, block, period, most_queues, seed, doc_id, text, source) -> DataFrame:
    """As ``mix``, with the kept columns in one column ``row``."""
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id)).alias("key"),
    )
    # One row per source, counted once for all that follows.
    ensure_checkpoint_dir(docs.sparkSession)
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("total")).checkpoint()
    if weights is None:
        weight = lifted(F.col("total"), exponent)
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map()
        weight = F.coalesce(given[F.col("source")].cast("double"), F.lit(0.0))
    # Weighed by source, before some of them share a queue.
    sources = sources.withColumn("weight", weight)
    own = sources.orderBy(F.desc("weight"), F.desc("total"), "source").limit(most_queues)
    own = own.select("source", F.col("source").alias("queue"))
    # At most ``most_queues`` rows, by the limit above.
    named = lambda table: table.join(F.broadcast(own), "source", "left").withColumn("queue", F.coalesce("queue", F.lit(OTHERS)))
    rows = named(rows)

    queues = named(sources).groupBy("queue").agg(*[F.sum(x).alias(x) for x in ("rows", "total", "weight")])
    # A row per queue, at most ``most_queues`` and one.
    told = {r.queue: r for r in queues.collect()}
    # Documents without text at the end of a queue begin where its last block may have ended.
    blocks = {queue: r.total // block + 1 for queue, r in told.items()}
    dealt = slots(docs.sparkSession, {queue: r.weight for queue, r in told.items()}, blocks, period).checkpoint()

    slices = queues.select("queue", F.greatest(F.lit(1), F.ceil(F.col("rows") / SLICE)).cast("long").alias("slices"))
    # As many rows as there are queues.
    placed = rows.join(F.broadcast(slices), "queue").withColumn("slice", F.pmod(F.shiftrightunsigned("key", 20), "slices"))
    parts = placed.groupBy("queue", "slice").agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy("queue").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("queue", "slice", "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    # The slots of a slice's blocks go to its documents with the slice's place.
    held = parts.withColumn("block", F.explode(F.expr(f"sequence(before div {block}, (before + size) div {block})")))
    turn = F.struct("block", "slot", "release", "deadline")
    parts = (
        held.join(dealt, ["queue", "block"])
        .groupBy("queue", "slice", "before")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    inside = Window.partitionBy("queue", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        placed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(parts, ["queue", "slice"])
        .withColumn("start", F.col("before") + F.col("within"))
    )
    turn = F.expr(f"get(turns, int(start div {block} - before div {block}))")
    return placed.select("row", "queue", "start", turn.alias("turn")).select("row", "queue", "start", "turn.*")


def mixed_order(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    exponent: float = 0.7,
    block: int = 65536,
    period: int = PERIOD,
    most_queues: int = 256,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` in the order of the mixture (see ``mix``), across and within partitions; columns as they were."""
    timed = _timed(docs, ("*",), weights, exponent, block, period, most_queues, seed, doc_id, text, source)
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = timed.repartitionByRange(count, "slot", "start").sortWithinPartitions("slot", "start")
    return ordered.select("row.*")
