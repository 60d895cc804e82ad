"""Near copies: MinHash signatures, bands, exact confirmation, connected components.

1. Every text gets the minima of ``bands * rows`` universal hashes over its shingles.
2. Texts with equal sets are one class, which its smallest id stands for.
3. Texts that share a band are a bucket. Its members are compared with one of them only, its centre: the
   member whose buckets hold most texts, for that is the most typical one. A pair is dropped if one-bit
   signatures (the lowest bit of each minimum) are farther apart than a link's ever are but by a stated chance; the
   others are confirmed on their full sets.
4. Confirmed pairs and classes give components. Buckets that still hold several components may have
   links that a comparison with the centre has not shown. Their members' shingles are put into one order, with
   frequent ones last. Two sets that reach the threshold share one of their first few shingles (the prefix
   filter: so few that the rest alone could not make up for them), so only members of different
   components that share such a shingle are compared. Links that this finds join components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shelf import Shelf
from .words import U, mixed, numbers, per_set, pieces, shingles

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, s1 long, s2 long, bands array<long>"


def _signatures(k: int, bands: int, rows: int):
    """Arrow batches of (doc_id, text) to SIGNED: size and digest of the set, signature bits, band keys."""
    factors, addends = numbers(11, bands * rows) | U(1), numbers(12, bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingles(batch.column("text"), k)
            n = batch.num_rows
            minima = np.empty((bands * rows, n), U)
            for i, (factor, addend) in enumerate(zip(factors, addends)):
                minima[i] = per_set(sets, sets.hashes * factor + addend, np.minimum, 0)
            minima >>= U(32)
            keys = np.zeros((bands, n), U)
            for i in range(bands):
                keys[i] = U(i)
                for j in range(rows):
                    keys[i] = mixed(keys[i] * U(0x9E3779B97F4A7C15) + minima[i * rows + j])
            # The lowest bit of a hashed minimum: equal for equal minima, else by chance.
            bits = np.packbits((mixed(minima) & U(1)).astype(np.uint8)[:128], axis=0, bitorder="little")
            signature = np.zeros((16, n), np.uint8)
            signature[: len(bits)] = bits
            halves = np.ascontiguousarray(signature.T).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(sets.first)),
                    pa.array(per_set(sets, mixed(sets.hashes), np.add, 0).view(np.int64)),
                    pa.array(per_set(sets, mixed(sets.hashes + U(7)), np.bitwise_xor, 0).view(np.int64)),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(np.ascontiguousarray(keys.T).ravel().view(np.int64))
                    ),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "s1", "s2", "bands"],
            )

    return run


def _overlaps(k: int):
    """Arrow batches of (a, b, text_a, text_b) to (a, b, both, either): sizes of intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(pieces(batches, "text_a"), "text_b"):
            left, right = shingles(batch.column("text_a"), k), shingles(batch.column("text_b"), k)
            owner = np.concatenate([left.owner, right.owner])
            hashes = np.concatenate([left.hashes, right.hashes])
            order = np.lexsort((hashes, owner))
            owner, hashes = owner[order], hashes[order]
            same = (owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1])
            both = np.bincount(owner[1:][same], minlength=batch.num_rows)
            either = np.diff(left.first) + np.diff(right.first) - both
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(both.astype(np.int64)), pa.array(either.astype(np.int64))],
                ["a", "b", "both", "either"],
            )

    return run


def _all_shingles(k: int):
    """Arrow batches of (text) to (shingle): one row per distinct shingle of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(shingles(batch.column("text"), k).hashes.view(np.int64))], ["shingle"])

    return run


PREFIX = "shingle long, doc_id long, n_shingles long, root long, place long, s1 long, s2 long"


def _prefixes(k: int, percent: int, frequent: np.ndarray):
    """Arrow batches of (doc_id, n_shingles, root, smallest, s1, s2, text) to PREFIX: the first shingles of each text.

    The order of shingles is by hash, but those of ``frequent`` come last, in their order. Any order that all texts
    share is right; this one keeps shingles that very many texts have out of the prefixes.
    """
    sorted_ = np.argsort(frequent)
    known = frequent[sorted_]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingles(batch.column("text"), k)
            size = np.diff(sets.first)
            told, smallest = (batch.column(c).to_numpy() for c in ("n_shingles", "smallest"))
            # The least overlap of a link, given the smallest set of the buckets a text is in.
            other = np.maximum(smallest, -(-size * percent // 100))
            overlap = -(-(size + other) * percent // (100 + percent))
            # A row is for the texts of its id that have as many shingles as it says.
            keep = np.where(told == size, np.maximum(size - overlap + 1, 0), 0)
            at = np.minimum(np.searchsorted(known, sets.hashes), max(len(known) - 1, 0))
            last = known[at] == sets.hashes if len(known) else np.zeros(len(sets.hashes), bool)
            key = np.where(last, sorted_[at] if len(known) else 0, sets.hashes).astype(U)
            order = np.lexsort((key, last, sets.owner))
            place = np.arange(len(order)) - sets.first[:-1][sets.owner] + 1
            some = place <= keep[sets.owner]
            owner = pa.array(sets.owner[some])
            columns = [pa.array(sets.hashes[order][some].view(np.int64)), *(batch.column(c).take(owner) for c in ("doc_id", "n_shingles", "root"))]
            columns += [pa.array(place[some]), *(batch.column(c).take(owner) for c in ("s1", "s2"))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PREFIX.split(", ")])

    return run


def _far_apart(percent: int, bits: int, lost: float) -> int:
    """The most signature bits in which two sets of similarity ``percent`` differ, but for a chance of ``lost``.

    A bit differs if the minima do and their bits happen to: the number is binomial, and this its exact tail.
    """
    p = (100 - percent) / 200
    tail, limit = 1.0, -1
    while tail >= lost and limit < bits:
        limit += 1
        tail = sum(math.comb(bits, i) * p**i * (1 - p) ** (bits - i) for i in range(limit + 1, bits + 1))
    return limit


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity: a, b."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    sizes = both.mapInArrow(_overlaps(k), "a long, b long, both long, either long")
    return sizes.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def _split(members: DataFrame) -> DataFrame:
    """Members (key, doc_id, n_shingles, root) of buckets with several roots, with the smallest set of their bucket."""
    several = members.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min("n_shingles").alias("smallest")
    )
    return members.join(several.where("low < high").select("key", "smallest"), "key")


def near_copies(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 4,
    lost: float = 1e-12,
    hot: int = 65_536,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two texts are linked if their sets of ``k``-word shingles (A-Z in lower case) have at least
    ``percent`` hundredths of their union in common. ``component_id`` is the smallest id that links
    reach, ``kept`` marks that document. A text of fewer words is one shingle. NULL and empty texts
    have no shingles and no links. A NULL id is kept, with a NULL component. Rows that repeat an id
    are all returned and share a component; their texts' links all count. A very long text is one set,
    whatever its size. An empty table gives no rows. Other columns do not matter.

    A link of similarity 0.85 shares none of 32 bands of 4 once in 10^10 times; signatures hide a link
    with a chance of ``lost``. ``hot`` bounds the frequent shingles that tasks are told; it bears on speed alone.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "near-copies")
    rows_in = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = shelf.put("signed", rows_in.mapInArrow(_signatures(k, bands, rows), SIGNED))

    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Cut off before it is joined: both sides of the join are then shuffled for it, and a hot class can be split.
    classes = shelf.put("classes", some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("doc_id")))
    members = some.join(classes.withColumnRenamed("doc_id", "rep"), ["d1", "d2", "n_shingles"])
    copies = members.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    reps = shelf.put("reps", members.where("doc_id = rep").dropDuplicates(["doc_id", "d1", "d2"]).drop("rep"))

    # Buckets: only (key, id) moves. Keys of one text alone do not matter.
    buckets = reps.select(F.explode("bands").alias("key"), "doc_id", "n_shingles")
    sized = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    sized = shelf.put("sized", sized.where("least < most").select("key", "size"))
    bucketed = shelf.put("bucketed", buckets.join(sized, "key"))
    typical = bucketed.groupBy("doc_id").agg(F.sum("size").alias("typical"))
    centres = bucketed.join(typical, "doc_id").groupBy("key").agg(F.max(F.struct("typical", (-F.col("doc_id")).alias("other"))).alias("top"))
    centres = shelf.put("centres", centres.select("key", (-F.col("top.other")).alias("centre")))
    stars = bucketed.join(centres, "key").where("doc_id != centre").select(
        F.greatest("doc_id", "centre").alias("a"), F.least("doc_id", "centre").alias("b")
    )
    stars = shelf.put("stars", stars.distinct())
    signatures = reps.select("doc_id", "s1", "s2")
    limit = _far_apart(percent, min(bands * rows, 128), lost)
    # Texts that share a bucket; all others are out from here on.
    texts = shelf.put("texts", rows_in.join(bucketed.select("doc_id").distinct(), "doc_id", "left_semi"))

    apart = sum(F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in ("s1", "s2"))
    alike = (
        stars.join(signatures.alias("x"), F.col("a") == F.col("x.doc_id"))
        .join(signatures.alias("y"), F.col("b") == F.col("y.doc_id"))
        .where(apart <= limit)
        .select("a", "b")
        .distinct()
    )
    roots = components(shelf.put("links", confirmed(alike, texts, k, percent).unionByName(copies)))

    # Buckets that are still split.
    placed = bucketed.join(roots, F.col("doc_id") == F.col("node"), "left")
    placed = shelf.put("placed", placed.select("key", "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("root")))
    members = _split(placed).groupBy("doc_id", "n_shingles", "root").agg(F.min("smallest").alias("smallest"))
    members = shelf.put("members", members.join(signatures, "doc_id"))
    open_ = shelf.put("open", texts.select("doc_id", "text").join(members, "doc_id"))
    # Shingles of every sixteenth text tell which ones are frequent, the most frequent last; this settles an order only.
    told = open_.where(F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0).select("text").mapInArrow(_all_shingles(k), "shingle long")
    told = told.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 2").orderBy(F.desc("n"), "shingle").limit(hot)
    frequent = told.toArrow().column("shingle").to_numpy()[::-1].astype(np.int64).view(U)
    # Cut in the row: only the first shingles of a text are sent.
    prefix = open_.select("doc_id", "n_shingles", "root", "smallest", "s1", "s2", "text").mapInArrow(_prefixes(k, percent, frequent), PREFIX)
    prefix = shelf.put("prefix", prefix)
    several = prefix.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    prefix = shelf.put("shared", prefix.distinct().join(several.select("shingle"), "shingle"))
    x, y = prefix.alias("x"), prefix.alias("y")
    # Before their first common shingle, each may have no more of its own than the pair's least overlap leaves.
    overlap = F.ceil((F.col("x.n_shingles") + F.col("y.n_shingles")) * percent / (100 + percent) - 1e-9)
    early = F.greatest(F.col("x.place") - F.col("x.n_shingles"), F.col("y.place") - F.col("y.n_shingles")) + overlap <= 1
    rest = x.join(
        y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") < F.col("y.root")) & early & (apart <= limit)
    ).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
    rest = rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rest = shelf.put("rest", rest.join(stars, ["a", "b"], "left_anti"))
    more = shelf.put("more", confirmed(rest, texts, k, percent))
    if not more.isEmpty():
        roots = _joined(roots, more)
    shelf.drop(*(name for name in list(shelf.paths) if name != "signed"))

    placed = signed.select("doc_id", "n_shingles").join(roots, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("root", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after further links (a, b): only links between roots go through components again."""
    at = lambda column: F.coalesce("root", column)
    known = roots.select("node", "root")
    ends = links.join(known, F.col("a") == F.col("node"), "left").select(at("a").alias("a"), "b")
    ends = ends.join(known, F.col("b") == F.col("node"), "left").select("a", at("b").alias("b"))
    higher = components(ends).select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = known.join(higher, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    # Roots that are roots no more. They were no nodes before.
    return moved.unionByName(higher.select(F.col("old").alias("node"), F.col("new").alias("root")))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the documents that have a near copy of smaller id; columns as they were."""
    gone = near_copies(docs, doc_id=doc_id, **how).where("NOT kept").select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(gone, doc_id, "left_anti").select(docs.columns)
