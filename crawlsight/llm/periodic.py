"""Words that repeat with a period: all maximal runs of each text, and the texts with each run cut to its first period.

1. A run of period p and ``exponent`` periods or more covers a place of the grid of p: places as far apart as
   the words that equal the word p further on are many. All grids together have n log n places (the
   harmonic sum). Places whose words, and a few words around, do not fit are passed over.
2. For the texts with places left, longest common extensions (LCE) give each run's ends. Only the suffixes
   at places of a difference cover modulo ``len(SHIFT)`` are sorted, by words first, then by doubling. Two
   places are fewer words than that away from places of the cover, which a minimum over neighbouring
   common prefixes (a sparse table) answers for.
3. The same ends found with several periods are one run of the least of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Texts, Words, pieces

# A perfect difference cover modulo 21; each difference is that of two of its members.
COVER, MODULUS = np.array([0, 1, 4, 14, 16]), 21
#: For each difference, the member of the cover from which that difference leads to another member.
SHIFT = np.array([next(c for c in COVER if (c + d) % MODULUS in COVER) for d in range(MODULUS)])
#: Words that are compared on each side of a grid's place before extensions are asked for.
NEAR = 8
#: Places of grids that are listed at once.
PLACES = 1 << 20


class Extensions:
    """Longest common extensions to the right in a sequence whose last symbol is unique."""

    def __init__(self, symbols: np.ndarray) -> None:
        n, step = len(symbols), len(COVER)
        most = int(symbols.max()) + 1 if n else 1
        self.symbols = np.concatenate([symbols, most + np.arange(2 * MODULUS)])
        order_of = np.full(MODULUS, -1)
        order_of[COVER] = np.arange(step)
        place = (np.arange(-(-n // MODULUS))[:, None] * MODULUS + COVER).ravel()
        self.order_of, self.n_samples = order_of, len(place)
        beyond = np.concatenate([self.symbols, np.full(MODULUS * 2, most)])
        levels = [self._by_words(beyond, np.minimum(place, n))]
        # Doubling: the sample one modulus further on is ``step`` samples further on.
        reach = step
        while len(place) and int(levels[-1].max()) + 1 < len(place):
            rank = levels[-1]
            after = np.zeros(len(rank), np.int64)
            after[: max(len(rank) - reach, 0)] = rank[reach:] + 1
            fresh = np.unique(rank.astype(np.int64) * (len(rank) + 2) + after, return_inverse=True)[1].astype(np.int32)
            if int(fresh.max()) == int(rank.max()):
                break  # only samples beyond the end are left
            levels.append(fresh)
            reach *= 2
        self.rank = np.empty(len(place), np.int64)
        order = np.argsort(levels[-1], kind="stable")
        self.rank[order] = np.arange(len(order))
        self.table = self._minima(self._neighbours(levels, order, place))

    def _by_words(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Ranks of the runs of ``MODULUS`` words from each place on, several words to a sort key."""
        bits = max(1, int(symbols.max()).bit_length())
        together = max(1, 63 // bits)
        keys = []
        for at in range(0, MODULUS, together):
            key = np.zeros(len(place), np.int64)
            for j in range(at, min(at + together, MODULUS)):
                key = (key << bits) | symbols[place + j]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(place), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(place), np.int32)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(self, levels: list[np.ndarray], order: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Words that each sorted sample and the next have in common."""
        x, y = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(x), np.int64)
        for k in reversed(range(len(levels))):
            hop = len(COVER) << k
            inside = np.flatnonzero((x < len(order)) & (y < len(order)))
            same = inside[levels[k][x[inside]] == levels[k][y[inside]]]
            x[same] += hop
            y[same] += hop
            common[same] += MODULUS << k
        inside = np.flatnonzero((x < len(order)) & (y < len(order)))
        end = len(self.symbols) - MODULUS
        a, b = np.minimum(place[x[inside]], end), np.minimum(place[y[inside]], end)
        common[inside] += self._direct(a, b, np.full(len(a), MODULUS))
        return common

    def _direct(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from a and b on, up to ``most``."""
        out = most.copy()
        left = np.arange(len(a))
        for t in range(int(most.max()) if len(most) else 0):
            left = left[most[left] > t]
            equal = self.symbols[a[left] + t] == self.symbols[b[left] + t]
            out[left[~equal]] = t
            left = left[equal]
            if not len(left):
                break
        return out

    def _minima(self, values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on; a and b differ."""
        to_cover = (SHIFT[(b - a) % MODULUS] - a) % MODULUS
        out = self._direct(a, b, to_cover)
        far = np.flatnonzero(out == to_cover)
        x, y = (self._sample(p[far] + to_cover[far]) for p in (a, b))
        known = np.flatnonzero((x < self.n_samples) & (y < self.n_samples))
        p, q = self.rank[x[known]], self.rank[y[known]]
        low, high = np.minimum(p, q), np.maximum(p, q)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        more = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            more[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << int(k))])
        out[far[known]] += more
        return out

    def _sample(self, place: np.ndarray) -> np.ndarray:
        return place // MODULUS * len(COVER) + self.order_of[place % MODULUS]


class Runs(NamedTuple):
    """Runs of texts, by text, start and period; places are numbers of words in the text."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _grid(n: np.ndarray, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place) of all places of the grids of all periods, some at a time; ``n`` counts the words of each text."""
    widest = np.where(n >= least, n // exponent, 0)
    gone = np.cumsum(widest)
    low, total = 0, int(gone[-1]) if len(gone) else 0
    while low < total:
        # As many (text, period) as there may be places: most grids have a few only.
        pair = np.arange(low, min(low + PLACES // 4, total))
        text = np.searchsorted(gone, pair, "right")
        period = pair - (gone[text] - widest[text]) + 1
        step = np.maximum(least - period, (exponent - 1) * period)
        many = (n[text] - period) // step
        ends = np.cumsum(many)
        at = 0
        while at < len(pair):
            high = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PLACES, "right")))
            size = many[at:high]
            turn = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + 1
            yield np.repeat(text[at:high], size), np.repeat(period[at:high], size), turn * np.repeat(step[at:high], size) - 1
            at = high
        low += len(pair)


def _fit(words: np.ndarray, first: np.ndarray, text: np.ndarray, period: np.ndarray, place: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Which places may lie in a run: the few words around them allow ``need`` equal pairs one after the other."""
    begin, end = first[text], first[text + 1]
    known = np.zeros(len(text), np.int64)
    open_ = np.zeros(len(text), bool)
    for way in (1, -1):
        left = np.arange(len(text))
        at = begin + place + (0 if way == 1 else -1)
        for _ in range(NEAR):
            inside = (at[left] >= begin[left]) & (at[left] + period[left] < end[left])
            left = left[inside]
            left = left[words[at[left]] == words[at[left] + period[left]]]
            known[left] += 1
            at[left] += way
            if not len(left):
                break
        open_[left] = True
    return open_ | (known >= need)


def runs_of(words: np.ndarray, first: np.ndarray, least: int = 6, exponent: int = 4) -> Runs:
    """The maximal runs of texts; text t has the words (as numbers) from ``first[t]`` to ``first[t + 1]``.

    A run is as long as can be with a smallest period q, and has ``max(least, exponent * q)`` words or more.
    """
    n = np.diff(first)
    found = []
    for text, period, place in _grid(n, least, exponent):
        at = first[text] + place
        some = np.flatnonzero(words[at] == words[at + period])
        text, period, place = text[some], period[some], place[some]
        need = np.maximum(least - period, (exponent - 1) * period)
        some = np.flatnonzero(_fit(words, first, text, period, place, need))
        found.append((text[some], period[some], place[some]))
    text, period, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*found)) or [[], [], []]))
    if not len(text):
        return Runs(*[np.zeros(0, np.int64)] * 4)

    # The texts concerned, each between unique symbols.
    concerned, text = np.unique(text, return_inverse=True)
    size = n[concerned]
    begin = np.cumsum(size + 1) - size
    taken = np.arange(int(size.sum())) + np.repeat(first[concerned] - np.cumsum(size) + size, size)
    distinct, numbered = np.unique(words[taken], return_inverse=True)
    symbols = np.arange(int(size.sum()) + len(size) + 1)
    symbols[:] = len(distinct)
    symbols[begin - 1] += np.arange(len(size))
    symbols[-1] += len(size)
    symbols[np.arange(len(numbered)) + np.repeat(np.arange(len(size)) + 1, size)] = numbered
    here = begin[text] + place
    ahead = Extensions(symbols).common(here, here + period)
    last = len(symbols) - 1
    back = Extensions(np.ascontiguousarray(symbols[::-1])).common(last - here + 1, last - here - period + 1)
    start, length = place - back, back + ahead + period
    long = np.flatnonzero(length >= np.maximum(least, exponent * period))
    text, start, length, period = text[long], start[long], length[long], period[long]
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return Runs(concerned[text[order]], start[order], length[order], period[order])


def joined(texts: Texts, words: Words, keep: np.ndarray) -> pa.Array:
    """The words of each text that are to be kept, joined by one space."""
    size = words.end[keep] - words.start[keep] + 1
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    from_ = np.arange(total) + np.repeat(words.start[keep] - end + size, size)
    out = texts.data[np.minimum(from_, max(len(texts.data) - 1, 0))] if total else np.zeros(0, np.uint8)
    out[end - 1] = 32
    stay = np.concatenate([[0], np.cumsum(keep)])[words.first]
    bounds = np.concatenate([[0], end])[stay]
    # The space after a text's last word goes.
    cut = np.zeros(total, bool)
    cut[bounds[1:][np.diff(bounds) > 0] - 1] = True
    bounds = bounds - np.concatenate([[0], np.cumsum(cut)])[bounds]
    raw = out[~cut]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes()))


def _collapser(least: int, exponent: int):
    """Arrow batches of (doc_id, text) to (doc_id, n_words, starts, lengths, periods, collapsed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = Texts.of(batch.column("text"))
            words = Words.of(texts)
            found = runs_of(words.hashes(texts.data), words.first, least, exponent)
            change = np.zeros(len(words.start) + 1, np.int64)
            begin = words.first[found.text] + found.start
            np.add.at(change, begin + found.period, 1)
            np.add.at(change, begin + found.length, -1)
            keep = np.cumsum(change[:-1]) == 0
            at = pa.array(np.searchsorted(found.text, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (found.start, found.length, found.period)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(words.first)), *lists, joined(texts, words, keep).cast(pa.string())],
                ["doc_id", "n_words", "starts", "lengths", "periods", "collapsed"],
            )

    return run


def collapse_runs(
    docs: DataFrame, least: int = 6, exponent: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, runs, collapsed.

    ``runs`` is an array of (start, length, period) in words, by start, then period: all stretches with a smallest
    period q and ``max(least, exponent * q)`` words or more that no neighbouring word extends; ``exponent`` is 2
    at least. ``collapsed`` are the words that no run contains after its first period, joined by one space.

    A NULL or empty text has no words, no runs and an empty ``collapsed``. A NULL id stays, repeated rows are each
    judged. Words are told apart by 64-bit hashes. Runs may overlap and may start together. A long text is one
    sequence, whatever its length; memory grows with it and with nothing else. An empty table gives no rows. Other
    columns do not matter.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(
        _collapser(least, exponent),
        "doc_id long, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string",
    )
    runs = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return found.select("doc_id", "n_words", runs.alias("runs"), "collapsed")
