"""Long passages that an earlier document has: anchors, FM-index shards, backward search.

1. Every window of ``window`` words has an anchor: its run of ``gram`` words with the least hash. Equal
   windows have equal anchors, so only windows whose anchor occurs in several documents can be shared.
   Neighbouring windows of one anchor are a segment.
2. Segments go to shards by anchor. A shard holds each distinct segment once, with the smallest
   document that has it, in an FM-index: the Burrows-Wheeler transform of its words in a wavelet
   matrix. All segments are streamed through backward search, which slides the window to the left by
   one word at a time, and each window's suffix interval gives the smallest document that has it.
3. An anchor with more than ``most`` segments would make its shard too large. Its windows are hashed one by
   one and counted by hash instead, which splits any such group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .words import Texts, U, Words, mixed, numbers, pieces, runs

# Windows in one segment at most: bounds a segment where words repeat without end.
LONGEST = 64
# Segments of one shard, about, and of one anchor at most: what a task holds in memory.
SHARD = 20000


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def segments_of(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor hash) of each segment of texts given by their words' hashes."""
    n = len(hashes)
    if n < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),)
    grams = runs(hashes, gram)
    mask = U((1 << int(n).bit_length()) - 1)
    least = sliding_minimum((grams & ~mask) | np.arange(len(grams), dtype=U), window - gram + 1)
    anchor = grams[(least & mask).astype(np.int64)]
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(anchor)]
    at = np.flatnonzero(np.arange(len(anchor)) + window <= first[1:][owner])
    anchor, owner = anchor[at], owner[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    inside = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(inside % LONGEST == 0)
    return owner[begin], at[begin] - first[:-1][owner[begin]], np.diff(np.append(begin, len(at))), anchor[begin]


def _anchors(window: int, gram: int):
    """Arrow batches of (doc_id, version, text) to (key, doc_id, version, at, n): one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Texts.of(batch.column("text"))
            words = Words.of(texts)
            owner, at, n, anchor = segments_of(words.hashes(texts.data), words.first, window, gram)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), batch.column("doc_id").take(rows), batch.column("version").take(rows), pa.array(at), pa.array(n)],
                ["key", "doc_id", "version", "at", "n"],
            )

    return run


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .., begin[0] + size[0] - 1, begin[1], .."""
    return np.arange(int(size.sum())) + np.repeat(begin - np.cumsum(size) + size, size)


def _digests(hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each run of words."""
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = hashes[_spread(begin, size)]
    place = _spread(np.zeros(len(size), np.int64), size)
    starts = np.cumsum(size) - size
    out = []
    for seed in (41, 42):
        weight = numbers(seed, int(size.max())) | U(1)
        out.append(mixed(np.add.reduceat(words * weight[place], starts) + size.astype(U)).view(np.int64))
    return out[0], out[1]


def _extract(window: int, content: bool, single: bool):
    """Arrow batches of (doc_id, version, text, spots) to segments (or, ``single``, to windows) with two hashes, and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # With content, a task sends a segment again only for a smaller document.
        least: dict[tuple[int, int], int] = {}
        for batch in pieces(batches, "text", 1 << 20):
            texts = Texts.of(batch.column("text"))
            words = Words.of(texts)
            hashes = words.hashes(texts.data)
            spots = batch.column("spots")
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(spots).to_numpy())
            cells = spots.flatten()
            key, at, n = (cells.field(name).to_numpy() for name in ("key", "at", "n"))
            if single:
                owner, key, at, n = np.repeat(owner, n), np.repeat(key, n), _spread(at, n), np.ones(int(n.sum()), np.int64)
            begin, size = words.first[:-1][owner] + at, n + window - 1
            c1, c2 = _digests(hashes, begin, size)
            if content:
                docs = batch.column("doc_id").to_numpy()[owner].tolist()
                fresh = np.zeros(len(owner), bool)
                for i, (digest, doc) in enumerate(zip(c1.tolist(), docs)):
                    if doc < least.get((digest, key[i]), doc + 1):
                        least[digest, key[i]] = doc
                        fresh[i] = True
                owner, key, begin, size, c1, c2 = (x[fresh] for x in (owner, key, begin, size, c1, c2))
            rows = pa.array(owner)
            columns = {
                "key": pa.array(key),
                "c1": pa.array(c1),
                "c2": pa.array(c2),
                "doc_id": batch.column("doc_id").take(rows),
            }
            if content:
                # The texts again with one space after each word; a segment is a slice of it.
                long = words.end - words.start + 1
                plain = texts.data[np.minimum(_spread(words.start, long), len(texts.data) - 1)]
                plain[np.cumsum(long) - 1] = 32
                edge = np.concatenate([[0], np.cumsum(long)])
                low, high = edge[begin], edge[begin + size] - 1
                ends = np.concatenate([[0], np.cumsum(high - low)]).astype(np.int64)
                columns["content"] = pa.LargeStringArray.from_buffers(
                    len(owner), pa.py_buffer(ends.tobytes()), pa.py_buffer(plain[_spread(low, high - low)].tobytes())
                ).cast(pa.string())
            else:
                columns |= {"version": batch.column("version").take(rows), "at": pa.array(at), "n": pa.array(n)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


class Bits:
    """Rank over a bit vector: packed words, and the ones before each."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(U)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = (U(1) << (at & 63).astype(U)) - U(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def step(self, at: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Places on the next level of the wavelet matrix, for bits that are set where ``one`` is."""
        ones = self.rank(at)
        return np.where(one, self.zeros + ones, at - ones)


class FMIndex:
    """Backward search over a sequence of symbols from 1, in which 0 ends each part.

    Suffixes are sorted by their first 2 * ``half`` symbols, which is enough for patterns that long.
    """

    def __init__(self, symbols: np.ndarray, window: int) -> None:
        n = len(symbols)
        rank, depth = symbols.astype(np.int64), 1
        half = 1 << (window - 1).bit_length() - 1
        self.window, kept = window, rank
        while True:
            if depth == half:
                kept = rank
            after = np.zeros(n, np.int64)
            after[: n - depth] = rank[depth:] + 1 if n > depth else 0
            pair = rank * (int(after.max(initial=0)) + 1) + after
            order = np.argsort(pair, kind="stable")
            new = np.ones(n, bool)
            new[1:] = pair[order][1:] != pair[order][:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new) - 1
            depth *= 2
            if depth >= 2 * half:
                break
        self.suffixes = order
        last = symbols[order - 1]
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=1 << self.bits))])
        self.levels = []
        for level in reversed(range(self.bits)):
            ones = (last >> level & 1).astype(bool)
            self.levels.append(Bits(ones))
            last = np.concatenate([last[~ones], last[ones]])
        # Where each symbol's block begins below the last level.
        every = np.arange(1 << self.bits)
        self.begin = np.zeros(1 << self.bits, np.int64)
        for level, bits in zip(reversed(range(self.bits)), self.levels):
            self.begin = bits.step(self.begin, (every >> level & 1).astype(bool))
        # Suffixes that agree in their first window - 1, or window, symbols are neighbours.
        self.shorter = self._groups(kept, half, window - 1)
        self.full = self._groups(kept, half, window)

    def _groups(self, rank: np.ndarray, half: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The group of each suffix in order, and where the groups begin; two overlapping halves tell equality."""
        other = np.minimum(self.suffixes + (length - half), len(rank) - 1)
        new = np.ones(len(rank), bool)
        new[1:] = (rank[self.suffixes][1:] != rank[self.suffixes][:-1]) | (rank[other][1:] != rank[other][:-1])
        return np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(rank))

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with ``symbol`` put before them."""
        for level, bits in zip(reversed(range(self.bits)), self.levels):
            one = (symbol >> level & 1).astype(bool)
            low, high = bits.step(low, one), bits.step(high, one)
        before = self.counts[symbol] - self.begin[symbol]
        return before + low, before + high

    def windows(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pattern, window, group) for every window of the patterns, which are parts of the index; from right to left."""
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), len(self.suffixes))
        for step in range(int(size.max(initial=0))):
            active = int(np.searchsorted(-size, -step, "left"))
            low, high, order, begin, size = (x[:active] for x in (low, high, order, begin, size))
            if step >= self.window:
                group, edge = self.shorter
                low, high = edge[group[low]], edge[group[low] + 1]
            low, high = self.extend(low, high, symbols[begin + size - 1 - step])
            if step >= self.window - 1:
                yield order, size - 1 - step, self.full[0][low]


def _shard(window: int):
    """One shard's distinct segments (key, c1, c2, content, least) to (key, c1, c2, least, runs): runs of shared windows."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = table.column("content").combine_chunks()
        column = column if isinstance(column, pa.Array) else column.chunk(0)
        texts = Texts.of(column)
        words = Words.of(texts)
        _, symbol = np.unique(words.hashes(texts.data), return_inverse=True)
        size = np.diff(words.first)
        # A zero after each segment.
        symbols = np.insert(symbol + 1, words.first[1:], 0)
        begin = words.first[:-1] + np.arange(len(size))
        least = table.column("least").to_numpy()
        index = FMIndex(symbols, window)
        owner = np.repeat(least, size + 1)
        smallest = np.minimum.reduceat(owner[index.suffixes], index.full[1][:-1])
        shared = np.zeros(len(symbols), bool)
        for segment, place, group in index.windows(symbols, begin, size):
            shared[begin[segment] + place] = smallest[group] < least[segment]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], shared]).astype(np.int8)))
        # Edges alternate: a run begins, a run ends; the zeros between segments end every run.
        lists = np.searchsorted(edges, np.append(begin, len(symbols)))
        local = edges - np.repeat(begin, np.diff(lists))
        runs_of = pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), pa.array(local))
        return pa.table([table.column(c) for c in ("key", "c1", "c2", "least")] + [runs_of], ["key", "c1", "c2", "least", "runs"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of (doc_id, text, spans) to (doc_id, n_words, n_removed, kept): words outside the spans."""
    for batch in batches:
        counts, removed, kept = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            counts.append(len(words))
            if spans.is_valid and len(spans):
                rest, at = [], 0
                for low, high in sorted((s["low"], s["high"]) for s in spans.as_py()):
                    if low > at:
                        rest += words[at:low]
                    at = max(at, high)
                words = rest + words[at:]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def without_repeats(
    docs: DataFrame, window: int = 50, gram: int = 10, most: int = SHARD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of ``window`` words covers it that also starts in a document of smaller
    id. Windows are judged on the input. Repeats within a document stay, and so do those of
    documents with the same id. NULL and empty texts have no words; a document with a NULL id
    neither loses words nor takes any from others. Repeated rows are answered one by one; an empty
    table gives no rows; other columns do not matter.
    """
    if not 0 < gram < window:
        raise ValueError("the anchor must be shorter than the window")
    ensure_checkpoint_dir(docs.sparkSession)
    # Rows of one id are told apart by their text.
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))

    anchors = rows.where("doc_id IS NOT NULL").mapInArrow(
        _anchors(window, gram), "key long, doc_id long, version long, at long, n long"
    )
    shared = anchors.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    spots = anchors.join(shared.select("key"), "key").distinct().checkpoint()
    crowded = spots.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most).select("key")
    shards = max(1, spots.count() // SHARD)

    def with_texts(some: DataFrame) -> DataFrame:
        by_doc = some.groupBy("doc_id", "version").agg(F.collect_list(F.struct("key", "at", "n")).alias("spots"))
        return rows.join(by_doc, ["doc_id", "version"]).select("doc_id", "version", "text", "spots")

    few = with_texts(spots.join(crowded, "key", "left_anti"))
    contents = few.mapInArrow(_extract(window, True, False), "key long, c1 long, c2 long, doc_id long, content string")
    # Dealt by shard once; the aggregation and the search both find their rows together.
    answers = (
        contents.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        .repartition("shard")
        .groupBy("shard", "key", "c1", "c2", "content")
        .agg(F.min("doc_id").alias("least"))
        .groupBy("shard")
        .applyInArrow(_shard(window), "key long, c1 long, c2 long, least long, runs array<long>")
    )
    placed = "key long, c1 long, c2 long, doc_id long, version long, at long, n long"
    found = few.mapInArrow(_extract(window, False, False), placed).join(answers, ["key", "c1", "c2"])
    # All windows of a later copy are shared; of the first copy, those in runs: begin, end, begin, end, ..
    pairs = F.expr(
        "CASE WHEN doc_id > least THEN array(struct(at AS low, at + n AS high)) WHEN size(runs) > 0 THEN "
        "transform(sequence(0, size(runs) - 2, 2), i -> struct(at + runs[i] AS low, at + runs[i + 1] AS high)) END"
    )
    judged = found.select("doc_id", "version", F.explode(pairs).alias("span"))
    judged = judged.select("doc_id", "version", "span.low", (F.col("span.high") + window - 1).alias("high"))
    many = with_texts(spots.join(crowded, "key", "left_semi")).mapInArrow(_extract(window, False, True), placed)
    leasts = many.groupBy("c1", "c2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    hashed = many.join(leasts, ["c1", "c2"]).where("doc_id > least")
    hashed = hashed.select("doc_id", "version", F.col("at").alias("low"), (F.col("at") + window).alias("high"))

    spans = judged.unionByName(hashed)
    spans = spans.groupBy("doc_id", "version").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    whole = rows.join(spans, ["doc_id", "version"], "left").select("doc_id", "text", "spans")
    return whole.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")
