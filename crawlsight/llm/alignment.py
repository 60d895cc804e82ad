"""Alignment of two tokenizers: which tokens of the one cover which of the other, document by document.

1. Both tokenizers encode each text. A text is parted where a space follows something that is no white
   space; neither tokenizer has a token across such a place, so a part's tokens depend on the part
   alone, and a worker remembers them.
2. Per batch, keyed by document, each token start finds the other side's covering token (``merge_asof``).
   Both directions together are the overlaps. Bytes where tokens of both sides end cut them into groups.
3. All pairs of a group are links. A document's distinct linked id pairs are written to the shared folder,
   and counted over all documents.
4. The ``hot`` most frequent id pairs are looked up where the documents lie. No other pair has more than
   one part in ``hot`` of all rows; those go through a join by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, fresh_dir
from .words import SPACE, Texts, U, Words, pieces

#: Bytes of text that are aligned at once; a longer text is a batch of its own.
BATCH = 1 << 20
#: Links that are listed at once.
LINKS = 1 << 21


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level tokenizers write for bytes: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """A byte-level tokenizer file, for texts with a space before them. Special tokens are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_of_letter()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes: list[bytes | None] = [None] * max(self.tokenizer.get_vocab_size(), max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]


class PieceTokens:
    """A sentence-piece model that sets a space before a text and has no piece with a space after something else."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces_ = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces_):
            raise ValueError("this model has pieces that cross from a word into the next")
        self.bytes: list[bytes | None] = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces_)
        ]
        self.space = [self.model.piece_to_id("▁")]

    def encode(self, parts: list[str]) -> list[list[int]]:
        # The model sets the first space itself; a part that is nothing else would be lost.
        found = self.model.encode([p[1:] for p in parts], num_threads=1)
        return [self.space if p == " " else ids for p, ids in zip(parts, found)]


class Tokens(NamedTuple):
    """Token i has the id ``ids[i]`` and the bytes ``[start[i], end[i])`` of a batch; ``doc`` is its text there."""

    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


class Remembered:
    """What one tokenizer makes of parts of texts; ids of up to ``MOST`` distinct parts are kept."""

    MOST = 1_000_000

    def __init__(self, tokens: ByteTokens | PieceTokens) -> None:
        self.tokens = tokens
        self.width = np.array([len(b) if b else 0 for b in tokens.bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.same = np.zeros(0, bool)
        self.store = np.zeros(0, np.int32)

    def learn(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        found: list[list[int]] = []
        for i in range(0, len(parts), 1000):
            found += self.tokens.encode([p.decode("utf-8", "replace") for p in parts[i : i + 1000]])
        table = self.tokens.bytes
        same = [b"".join([table[i] or b"" for i in ids]) == part for ids, part in zip(found, parts)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.at = np.concatenate([self.at, len(self.store) + np.cumsum(size) - size])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.same = np.concatenate([self.same, np.array(same, bool)])[order]
        self.store = np.concatenate([self.store, np.fromiter(chain.from_iterable(found), np.int32, int(size.sum()))])

    def place(self, distinct: np.ndarray, parts) -> np.ndarray:
        """Where each of the distinct hashes is kept; ``parts(flags)`` gives the bytes of those that are new."""
        if len(self.known) > self.MOST:
            self.forget()
        near = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        fresh = self.known[near] != distinct if len(self.known) else np.ones(len(distinct), bool)
        if fresh.any():
            self.learn(distinct[fresh], parts(fresh))
        return np.searchsorted(self.known, distinct)

    def flat(self, place: np.ndarray, doc: np.ndarray) -> Tokens:
        """The tokens of the parts, one after the other; ``doc`` names each part's text."""
        size = self.size[place]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.store[np.arange(total) + np.repeat(self.at[place] - ends + size, size)]
        end = np.cumsum(self.width[ids])
        return Tokens(ids, end - self.width[ids], end, np.repeat(doc, size))


def parted(column: pa.Array) -> tuple[Texts, Words]:
    """Texts with a space before each, and their parts: cut before a space that follows something other than white space.

    After white space beyond ASCII nothing is cut; what looks like it but is not costs a longer part only.
    An empty text has no space and no part.
    """
    texts = Texts.of(column)
    some = np.diff(texts.at) > 0
    begin = texts.at[:-1][some]
    data = np.insert(texts.data, begin, 32)
    at = texts.at + np.concatenate([[0], np.cumsum(some)])
    blank = SPACE | (np.arange(256) < 32)
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 32) & ~blank[data[:-1]]
    cut[at[:-1][some]] = True
    start = np.flatnonzero(cut)
    far = start[start >= 3]
    two, three = data[far - 2], data[far - 3]
    wide = ((two == 0xC2) & np.isin(data[far - 1], [0x85, 0xA0])) | (
        np.isin(three, [0xE1, 0xE2, 0xE3]) & np.isin(two, [0x80, 0x81, 0x9A, 0xA0])
    )
    cut[far[wide]] = False
    cut[at[:-1][some]] = True
    start = np.flatnonzero(cut)
    return Texts(data, at), Words(start, np.append(start[1:], len(data)), np.searchsorted(start, at))


def covering(of: Tokens, by: Tokens) -> np.ndarray:
    """For each token of ``of`` the number of the token of ``by`` that covers its first byte, in the same document."""
    left = pd.DataFrame({"start": of.start, "doc": of.doc})
    right = pd.DataFrame({"start": by.start, "doc": by.doc, "token": np.arange(len(by.ids))})
    return pd.merge_asof(left, right, on="start", by="doc")["token"].to_numpy(np.int64)


class Aligned(NamedTuple):
    """a, b: tokens; group_a, group_b: the group of each; over_a, over_b: token numbers of all overlaps."""

    n: int
    good: np.ndarray
    a: Tokens
    b: Tokens
    group_a: np.ndarray
    group_b: np.ndarray
    over_a: np.ndarray
    over_b: np.ndarray

    @property
    def groups(self) -> int:
        return int(self.group_a[-1]) + 1 if len(self.group_a) else 0

    def per_doc(self, doc: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc, weight, self.n).astype(np.int64)

    def of_groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of each side and the document of each group."""
        many_a, many_b = np.bincount(self.group_a, minlength=self.groups), np.bincount(self.group_b, minlength=self.groups)
        return many_a, many_b, self.a.doc[np.cumsum(many_a) - 1]


def aligned(column: pa.Array, one: Remembered, two: Remembered) -> Aligned:
    texts, parts = parted(column)
    n = len(texts.at) - 1
    doc = np.repeat(np.arange(n), np.diff(parts.first))
    each, distinct = pd.factorize(parts.hashes(texts.data))
    first = np.zeros(len(distinct), np.int64)
    first[each[::-1]] = np.arange(len(each))[::-1]

    def spelt(fresh: np.ndarray) -> list[bytes]:
        raw = texts.data.tobytes()
        return [raw[a:b] for a, b in zip(parts.start[first[fresh]].tolist(), parts.end[first[fresh]].tolist())]

    at_one, at_two = one.place(distinct, spelt), two.place(distinct, spelt)
    lost = ~(one.same[at_one] & two.same[at_two])
    good = np.diff(texts.at) > 0
    if lost.any():
        good[doc[lost[each]]] = False
    keep = slice(None) if good[doc].all() else good[doc]
    a, b = one.flat(at_one[each][keep], doc[keep]), two.flat(at_two[each][keep], doc[keep])

    under_a, under_b = covering(a, b), covering(b, a)
    # A pair that starts together is found from both sides; it counts once.
    own = a.start[under_b] != b.start
    over_a, over_b = np.concatenate([np.arange(len(a.ids)), under_b[own]]), np.concatenate([under_a, np.flatnonzero(own)])
    # Where both end: the token of b that covers a's start ends with it, or a later one does.
    place = np.searchsorted(b.end, a.end)
    cut_a = b.end[np.minimum(place, max(len(b.end) - 1, 0))] == a.end if len(b.end) else np.zeros(0, bool)
    cut_b = np.zeros(len(b.ids), bool)
    cut_b[place[cut_a]] = True
    return Aligned(n, good, a, b, np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b, over_a, over_b)


def links(x: Aligned, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, pair, times: the distinct linked id pairs (``a * wide + b``) of each document, sorted, and how often they are linked."""
    many_a, many_b, _ = x.of_groups()
    begin_b = np.cumsum(many_b) - many_b
    fan = many_b[x.group_a]
    gone = np.cumsum(fan)
    docs, pairs, times = [], [], []
    low = 0
    while low < len(fan):
        # At least one token of a; its partners are no more than a text has tokens.
        high = max(low + 1, int(np.searchsorted(gone, (gone[low - 1] if low else 0) + LINKS, "right")))
        f = fan[low:high]
        ends = np.cumsum(f)
        partner = np.arange(int(ends[-1])) + np.repeat(begin_b[x.group_a[low:high]] - ends + f, f)
        pair = np.repeat(x.a.ids[low:high].astype(np.int64) * wide, f) + x.b.ids[partner]
        told = _counted(np.repeat(x.a.doc[low:high], f), pair, np.ones(len(pair), np.int64))
        for store, values in zip((docs, pairs, times), told):
            store.append(values)
        low = high
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(docs) == 1:
        return docs[0], pairs[0], times[0]
    return _counted(np.concatenate(docs), np.concatenate(pairs), np.concatenate(times))


def _counted(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``times`` by (doc, pair), sorted."""
    base = int(pair.max()) + 1 if len(pair) else 1
    if len(doc) and base * (int(doc.max()) + 1) < 2**63:
        key = doc * base + pair
        if (times == 1).all():
            key, total = np.unique(key, return_counts=True)
            return key // base, key % base, total
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return doc[at], pair[at], np.add.reduceat(times[order], at) if len(at) else times


class Decimals:
    """Ids as decimal digits with a mark after each: ``digits[at[id]:at[id] + size[id]]`` are the digits."""

    def __init__(self, most: int) -> None:
        spelt = [b"%d" % i for i in range(most)]
        self.size = np.array([len(s) for s in spelt], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.digits = np.frombuffer(b"".join(spelt), np.uint8)


def spelt_groups(x: Aligned, decimals: Decimals) -> list[bytes]:
    """Per document ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    na, nb = len(x.a.ids), len(x.b.ids)
    many_a, many_b, doc = x.of_groups()
    before_a, before_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
    ids, mark, owner = np.empty(na + nb, np.int64), np.full(na + nb, 44, np.uint8), np.empty(na + nb, np.int64)
    # A token stands after the tokens of its side before it and the other side's tokens of earlier (for b: and of its own) groups.
    place_a = np.arange(na) + before_b[x.group_a] if na else np.zeros(0, np.int64)
    place_b = np.arange(nb) + (before_a + many_a)[x.group_b] if nb else np.zeros(0, np.int64)
    ids[place_a], ids[place_b] = x.a.ids, x.b.ids
    owner[place_a], owner[place_b] = x.a.doc, x.b.doc
    if na:
        mark[place_a[np.cumsum(many_a) - 1]] = 124
        mark[place_b[np.cumsum(many_b) - 1]] = 59
    size = decimals.size[ids] + 1
    end = np.cumsum(size)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    from_ = np.arange(len(out)) + np.repeat(decimals.at[ids] - end + size, size)
    out[:] = decimals.digits[np.minimum(from_, len(decimals.digits) - 1)]
    out[end - 1] = mark
    bounds = np.concatenate([[0], end])[np.searchsorted(owner, np.arange(x.n + 1))]
    raw = out.tobytes()
    # The mark after a document's last token goes.
    return [raw[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _of_process(one: str, two: str) -> tuple[Remembered, Remembered, Decimals]:
    """The tokenizers of this worker process, which serves one task after the other."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_aligners_of_process", {})
    if (one, two) not in kept:
        a, b = Remembered(ByteTokens(one)), Remembered(PieceTokens(two))
        kept[one, two] = a, b, Decimals(max(len(a.width), len(b.width)))
    return kept[one, two]


def _lists(doc: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    at = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))


COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string"


def _aligner(one: str, two: str, spelt: bool):
    """Arrow batches of (doc_id, text) to COUNTS, and the groups themselves or the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, decimals = _of_process(one, two)
        for batch in pieces(batches, "text", BATCH):
            x = aligned(batch.column("text"), first, second)
            many_a, many_b, doc = x.of_groups() if x.groups else (np.zeros(0, np.int64),) * 3
            groups = spelt_groups(x, decimals)
            names = COUNTS.replace(" long", "").replace(" string", "").split(", ")
            columns = [
                batch.column("doc_id"),
                pa.array(x.per_doc(x.a.doc)),
                pa.array(x.per_doc(x.b.doc)),
                pa.array(x.per_doc(doc)),
                pa.array(x.per_doc(doc, many_a * many_b)),
                pa.array(x.per_doc(x.a.doc[x.over_a])),
                pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
            ]
            if spelt:
                yield pa.RecordBatch.from_arrays([*columns, pa.array([g.decode() for g in groups], pa.string())], [*names, "groups"])
            else:
                owner, pair, times = links(x, len(second.width))
                columns += [_lists(owner, pair, x.n), _lists(owner, times, x.n)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "pairs", "times"])

    return run


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def groups(docs: DataFrame, byte_level: str, pieces_: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: COUNTS and ``groups``, the groups themselves (see ``align``)."""
    return _texts(docs, doc_id, text).mapInArrow(_aligner(byte_level, pieces_, True), f"{COUNTS}, groups string")


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches of (pairs) to (pair, n): sums over some millions of rows at a time."""
    known, count, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        fresh, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (known[:0], count[:0])
        both = np.concatenate([known, fresh])
        pair, at = np.unique(both, return_inverse=True)
        return pair, np.bincount(at, np.concatenate([count, n]), len(pair)).astype(np.int64)

    for batch in batches:
        values = batch.column("pairs").flatten().to_numpy()
        waiting.append(values)
        held += len(values)
        if held > LINKS:
            (known, count), waiting, held = merged(), [], 0
            if len(known) > LINKS:
                yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(count)], ["pair", "n"])
                known, count = known[:0], count[:0]
    known, count = merged()
    yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(count)], ["pair", "n"])


class Hot(NamedTuple):
    """Sorted id pairs, how many documents hold each, and whether it is the most frequent of its first id."""

    pair: np.ndarray
    n: np.ndarray
    best: np.ndarray


def _looked_up(hot: Hot, cold: bool):
    """Arrow batches of (row, pairs, times) to (row, n_best, count_sum) by the hot pairs, or to the others: (row, pair, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pairs")
            size = np.diff(lists.offsets.to_numpy())
            pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            owner = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(hot.pair, pair), max(len(hot.pair) - 1, 0))
            found = hot.pair[at] == pair if len(hot.pair) else np.zeros(len(pair), bool)
            if cold:
                rest = ~found
                rows = batch.column("row").take(pa.array(owner[rest]))
                yield pa.RecordBatch.from_arrays([rows, pa.array(pair[rest]), pa.array(times[rest])], ["row", "pair", "times"])
                continue
            at, owner, times = at[found], owner[found], times[found]
            # Sums of whole numbers, exact beyond what a double holds.
            sums = []
            for weight in (times * hot.best[at], times * hot.n[at]):
                gone = np.concatenate([[0], np.cumsum(weight)])
                place = np.searchsorted(owner, np.arange(len(size) + 1))
                sums.append(pa.array(gone[place[1:]] - gone[place[:-1]]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *sums], ["row", "n_best", "count_sum"])

    return run


def align(
    docs: DataFrame, byte_level: str, pieces_: str, hot: int = 65_536, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: COUNTS, n_best, count_sum.

    ``byte_level`` (a tokenizer file) encodes a space and the text, ``pieces_`` (a sentence-piece model) the
    text, before which it sets a space itself. n_a and n_b count tokens, n_overlaps pairs of tokens that share
    a byte, n_groups what the bytes cut at which tokens of both sides end, n_links pairs of tokens of one group.
    n_best counts the links whose id pair is linked in as many documents as any pair with that first id,
    count_sum adds up over links in how many documents their id pair is linked.

    NULL and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: zeros, and ''
    as groups_sha256. A NULL id is an id like others. Repeated rows are documents of their own, each counts. Pairs
    that are equally frequent are all the best. A long text is aligned as a whole; its links are listed
    ``LINKS`` at a time, and one row holds its distinct pairs. An empty table gives no rows. Other columns do not matter.
    ``hot`` bounds the pairs that every task knows, whatever the size of the input.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = fresh_dir(spark, "alignment")
    found = _texts(docs, doc_id, text).mapInArrow(
        _aligner(byte_level, pieces_, False), f"{COUNTS}, pairs array<long>, times array<long>"
    )
    found.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    # Written: the numbers of the rows are fixed.
    rows = spark.read.parquet(folder)
    counts = rows.select("pairs").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    wide = _wide(pieces_)
    counts = counts.withColumn("a", F.expr(f"pair div {wide}")).checkpoint()
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    # ``hot`` rows by the limit.
    top = counts.orderBy(F.desc("n"), "pair").limit(hot).toArrow().sort_by("pair")
    known = Hot(*(top.column(c).to_numpy().astype(np.int64) for c in ("pair", "n", "best")))

    looked = rows.select("row", "pairs", "times")
    told = looked.mapInArrow(_looked_up(known, False), "row long, n_best long, count_sum long")
    rest = looked.mapInArrow(_looked_up(known, True), "row long, pair long, times long").join(counts, "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    sums = told.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row").drop("row")


def _wide(path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path).get_piece_size()
