"""Packing documents into training sequences with a controlled mixture of sources.

Sources are queues of tokens. Deficit round-robin serves all queues in each round of ``window``
tokens: a queue's credit grows by its target share, it gets the whole tokens of its credit, and the
rest (its deficit) is carried into the next round. Credits depend on the number of the round alone,
so what a queue has got before any round is known without walking through the rounds before, and
every partition places its own documents. The rounds follow each other without gaps and are cut into
sequences of ``window`` tokens; the last, incomplete one is cut into powers of two, so nothing is
padded.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir, fresh_dir
from .mixing import OTHERS
from .words import Texts, Words, pieces

TOKENS = "part long, source string, doc_id long, before long, doc_tokens long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string"
)


def _byte_letters() -> dict[int, str]:
    """Letters for the bytes that are not printable, by the rule of byte-level tokenizers: 256, 257, .. in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {byte: chr(256 + i) for i, byte in enumerate(b for b in range(256) if b not in plain)}


class Encoder:
    """Token ids of texts, word by word; ids of up to ``MOST`` distinct words are remembered.

    Right for tokenizers that part texts at white space and drop it, which is tried out at the start.
    Words of letters, with a comma or full stop after them or not, go straight to the tokenizer's
    merges, if that gives the same ids for words tried out at the start; it saves most of the time.
    """

    MOST = 3_000_000
    TRIED = ("Word", "über", "ÉTÉ", "ciónñ", "e\u0301a", "ßa", "x", "Straße", "naïveté", "ǅ", "жар", "日本")

    def __init__(self, path: str, end: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else "<u4")
        one, two = self.full(["a b"]), self.full(["a", "b"])
        if one[0] != two[0] + two[1] or self.full([" a \n"]) != self.full(["a"]):
            raise ValueError("this tokenizer does not part texts at white space")
        self.merges, self.letters, self.bodies = self.tokenizer.model, _byte_letters(), {}
        self.marks = {mark: ids for mark, ids in zip(".,", self.full([".", ","]))}
        tried = [word + mark for word in self.TRIED for mark in ("", ".", ",")]
        self.direct = True
        self.direct = self.ids(tried) == self.full(tried)
        self._forget()

    @classmethod
    def of_process(cls, path: str, end: int) -> Encoder:
        """The encoder of this worker process, which serves one task after the other."""
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_encoders_of_process", {})
        if (path, end) not in kept:
            kept[path, end] = cls(path, end)
        return kept[path, end]

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.store = np.zeros(0, self.kind)

    def full(self, words: list[str]) -> list[list[int]]:
        out = []
        for i in range(0, len(words), 1000):
            out += [x.ids for x in self.tokenizer.encode_batch_fast(words[i : i + 1000], add_special_tokens=False)]
        return out

    def ids(self, words: list[str]) -> list[list[int]]:
        if not self.direct:
            return self.full(words)
        out: list = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            mark = self.marks.get(word[-1:])
            body = word if mark is None else word[:-1]
            if not body.isalpha() or "\u03a3" in body:
                rest.append(i)
                continue
            body = body.lower() if body.isascii() else unicodedata.normalize("NFC", body).lower()
            found = self.bodies.get(body)
            if found is None:
                if not body.isalpha():
                    rest.append(i)
                    continue
                plain = body if body.isascii() else body.encode().decode("latin-1").translate(self.letters)
                found = self.bodies[body] = [token.id for token in self.merges.tokenize(plain)]
            out[i] = found if mark is None else found + mark
        for i, found in zip(rest, self.full([words[i] for i in rest])):
            out[i] = found
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        order = np.argsort(hashes)
        hashes, words = hashes[order], [words[i] for i in order.tolist()]
        self.bodies = {}
        found = self.ids(words)
        self.bodies = {}
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), self.kind, int(size.sum()))
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.at = np.concatenate([self.at, len(self.store) + np.cumsum(size) - size])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.store = np.concatenate([self.store, flat])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, each text's with the end id; where each text begins (and the last ends)."""
        texts = Texts.of(column)
        words = Words.of(texts)
        each, distinct = pd.factorize(words.hashes(texts.data))
        first = np.zeros(len(distinct), np.int64)
        first[each[::-1]] = np.arange(len(each))[::-1]
        if len(self.known) > self.MOST:
            self._forget()
        near = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        fresh = self.known[near] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if fresh.any():
            data = texts.data.tobytes()
            some = first[fresh]
            spans = zip(words.start[some].tolist(), words.end[some].tolist())
            self._learn(distinct[fresh], [data[a:b].decode("utf-8", "replace") for a, b in spans])
        place = np.searchsorted(self.known, distinct)[each]
        # The end id is one more word at the end of each text.
        count = np.diff(words.first)
        size = np.insert(self.size[place], words.first[1:], 1)
        at = np.insert(self.at[place], words.first[1:], len(self.store))
        ends = np.cumsum(size)
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at - ends + size, size)
        flat = np.append(self.store, self.kind.type(self.end))[take]
        total = np.concatenate([[0], ends])
        return flat, total[np.concatenate([[0], np.cumsum(count + 1)])]


def _tokens(path: str, end: int):
    """Arrow batches of (source, doc_id, text) to TOKENS; before: tokens of that source earlier in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, before = None, {}
        for batch in pieces(batches, "text"):
            encoder = encoder or Encoder.of_process(path, end)
            flat, begin = encoder.encode(batch.column("text"))
            size = np.diff(begin)
            earlier = []
            for source, n in zip(batch.column("source").to_pylist(), size.tolist()):
                earlier.append(before.get(source, 0))
                before[source] = earlier[-1] + n
            width = encoder.kind.itemsize
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(size), [None, pa.py_buffer((begin * width).astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(size), part)),
                    batch.column("source"),
                    batch.column("doc_id"),
                    pa.array(earlier, pa.int64()),
                    pa.array(size),
                    ids.cast(pa.binary()),
                ],
                ["part", "source", "doc_id", "before", "doc_tokens", "ids"],
            )

    return run


class Phase(NamedTuple):
    """From credit ``begin`` on, queue q has got ``had[q]`` and gets ``weight[q] / whole`` of each further token."""

    begin: int
    had: list[int]
    weight: list[int]
    whole: int


class Rounds:
    """What each queue has got before each round. A queue that has ended leaves its share to the others, in a new phase."""

    def __init__(self, totals: list[int], weights: list[int], window: int) -> None:
        self.totals, self.window = totals, window
        self.phases: list[Phase] = []
        had, now = [0] * len(totals), 0
        while any(h < t for h, t in zip(had, totals)):
            active = [w if h < t else 0 for w, h, t in zip(weights, had, totals)]
            phase = Phase(now, had, active, sum(active))
            now += min(-(-(t - h) * phase.whole // w) for t, h, w in zip(totals, had, active) if w)
            self.phases.append(phase)
            had = self._got(phase, now)
        self.rounds = -(-now // window)
        self._known: dict[int, list[int]] = {}

    def _got(self, phase: Phase, credit: int) -> list[int]:
        gone = credit - phase.begin
        return [min(t, h + gone * w // phase.whole) for t, h, w in zip(self.totals, phase.had, phase.weight)]

    def before(self, turn: int) -> list[int]:
        """Tokens that each queue has got before round ``turn``."""
        known = self._known.get(turn)
        if known is None:
            if turn >= self.rounds:
                known = self.totals
            else:
                phase = max((p for p in self.phases if p.begin <= turn * self.window), key=lambda p: p.begin)
                known = self._got(phase, turn * self.window)
            if len(self._known) * len(self.totals) > 500_000:
                self._known.clear()
            self._known[turn] = known
        return known

    def turn_of(self, queue: int, token: int, near: int = 0) -> int:
        """The round that serves this token of the queue; ``near`` is no later than it."""
        low, step = near, 1
        while self.before(low + step)[queue] <= token:
            low += step
            step *= 2
        high = low + step
        while high - low > 1:
            middle = (low + high) // 2
            if self.before(middle)[queue] <= token:
                low = middle
            else:
                high = middle
        return low

    def spans(self, queue: int, start: int, length: int, near: int = 0) -> Iterator[tuple[int, int, int, int]]:
        """(round, token, length, place in the packed stream) of the pieces of a queue's tokens."""
        token, end, turn = start, start + length, near
        while token < end:
            turn = self.turn_of(queue, token, turn)
            now, then = self.before(turn), self.before(turn + 1)
            size = min(end, then[queue]) - token
            place = sum(now) + sum(then[:queue]) - sum(now[:queue]) + token - now[queue]
            yield turn, token, size, place
            token += size


class Sequences:
    """The packed stream cut into sequences: full windows, then the rest by powers of two, largest first."""

    def __init__(self, total: int, window: int) -> None:
        self.window, self.full = window, total // window
        rest, at = total % window, self.full * window
        self.tail = []
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                self.tail.append((at, at + (1 << bit)))
                at += 1 << bit

    def cut(self, place: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset there, length) of the parts of a span of the stream."""
        while length:
            if place < self.full * self.window:
                sequence, offset = divmod(place, self.window)
                room = self.window - offset
            else:
                sequence, (low, high) = next((self.full + i, x) for i, x in enumerate(self.tail) if place < x[1])
                offset, room = place - low, high - place
            size = min(room, length)
            yield sequence, offset, size
            place, length = place + size, length - size


def _placed(queues: list[str], rounds: Rounds, sequences: Sequences, wide: int):
    """Arrow batches of (doc_id, queue, start, doc_tokens, ids) to PIECES."""
    number = {queue: i for i, queue in enumerate(queues)}
    schema = pa.schema(
        [(name, pa.string() if name == "queue" else pa.int64()) for name in (f.split()[0] for f in PIECES.split(", "))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[str, tuple[int, int]] = {}
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for doc, queue, start, size, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                raw = memoryview(np.frombuffer(ids.as_buffer(), f"<u{wide}").astype("<u4").tobytes())
                seen, turn = near.get(queue, (0, 0))
                turn = turn if seen <= start else 0
                for turn, token, length, place in rounds.spans(number[queue], start, size, turn):
                    at = token - start
                    for sequence, offset, n in sequences.cut(place, length):
                        row = (doc, at, n, zlib.crc32(raw[4 * at : 4 * (at + n)]), size, sequence, offset, queue)
                        for column, value in zip(out, row):
                            column.append(value)
                        at += n
                near[queue] = (start, turn)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 4096,
    end: int = 2,
    weights: dict[str, float] | DataFrame | None = None,
    most_queues: int = 256,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per piece of a document: PIECES.

    ``tokenizer`` is the path of a tokenizer file that every executor has; each document ends with
    the id ``end``. ``weights`` are the target proportions of sources in every window until a queue has
    ended, by name or as rows (source, weight); without it they are the sources' shares of all tokens, so
    that all queues end together. Every id lies in
    exactly one piece; the pieces of a sequence fill it without gaps; all sequences have ``window``
    tokens but the last few, which have powers of two.

    NULL and empty texts have the end id alone. NULL sources are one source. The ``most_queues``
    sources of most weight have a queue each; all others share one, which weighs what they weigh together and
    takes them one after the other. Repeated rows are packed one by one,
    a NULL id stays NULL, an empty table gives no rows, other columns do not matter.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )
    tokens = rows.mapInArrow(_tokens(tokenizer, end), TOKENS).checkpoint()
    parts = tokens.groupBy("source", "part").agg(F.sum("doc_tokens").alias("total")).checkpoint()
    by_source = parts.groupBy("source").agg(F.sum("total").alias("total"))
    if weights is None:
        by_source = by_source.withColumn("weight", F.col("total"))
    else:
        if isinstance(weights, dict):
            weights = spark.createDataFrame(list(weights.items()), "source string, weight double")
        # Weighed by source, before some of them share a queue.
        by_source = by_source.join(weights.select("source", "weight"), "source", "left").fillna(0.0, "weight")
    # At most ``most_queues`` rows, by the limit; so are the totals below, plus one.
    own = by_source.orderBy(F.desc("weight"), F.desc("total"), "source").limit(most_queues)
    own = own.select("source", F.col("source").alias("queue"))
    named = lambda table: table.join(F.broadcast(own), "source", "left").withColumn("queue", F.coalesce("queue", F.lit(OTHERS)))
    parts = named(parts)
    found = named(by_source).groupBy("queue").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
    found = found.orderBy("queue").collect()
    totals = {r.queue: r.total for r in found}

    if weights is None:
        shares = list(totals.values())
    else:
        whole = sum(r.weight for r in found) or 1.0
        shares = [max(1, round(r.weight / whole * 10**12)) for r in found]
    rounds = Rounds(list(totals.values()), shares, window)
    earlier = Window.partitionBy("queue").orderBy("source", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("source", "part", "queue", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # Written, so that its size is known: while small it is broadcast and no token moves, later both sides are shuffled.
    folder = fresh_dir(spark, "packing-bases")
    bases.write.parquet(folder)
    bases = spark.read.schema(bases.schema).parquet(folder)
    placed = tokens.join(bases, ["source", "part"]).select(
        "doc_id", "queue", (F.col("base") + F.col("before")).alias("start"), "doc_tokens", "ids"
    )
    from tokenizers import Tokenizer

    wide = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end + 1) <= 1 << 16 else 4
    return placed.mapInArrow(_placed(list(totals), rounds, Sequences(sum(totals.values()), window), wide), PIECES)
