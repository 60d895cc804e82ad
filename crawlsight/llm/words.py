"""Words of texts as arrays: where they stand, and 64-bit hashes of words and of runs of words.

All work is on the bytes of an Arrow column, so no text becomes Python strings. Words are runs of
bytes other than space and the five ASCII controls from tab to carriage return.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit integers."""
    return mixed((np.arange(1, n + 1, dtype=U) + U(seed << 32)) * U(0x9E3779B97F4A7C15))



class Texts(NamedTuple):
    """Bytes of some texts one after the other; text i is ``data[at[i]:at[i + 1]]``."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if not len(column):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        return cls(data[at[0] : at[-1]], at - at[0])


class Words(NamedTuple):
    """Word i is ``data[start[i]:end[i]]``; text t has the words from ``first[t]`` to ``first[t + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: Texts) -> Words:
        data, at = texts
        if not len(data):
            return cls(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64))
        blank = SPACE[data]
        before, after = np.empty(len(data), bool), np.empty(len(data), bool)
        before[0] = after[-1] = True
        before[1:], after[:-1] = blank[:-1], blank[1:]
        inner = at[(at > 0) & (at < len(data))]
        before[inner] = True
        after[inner - 1] = True
        word = ~blank
        start = np.flatnonzero(word & before)
        end = np.flatnonzero(word & after) + 1
        return cls(start, end, np.searchsorted(start, at))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        hashed = mixed((self.end - self.start).astype(U) + U(0x9E3779B97F4A7C15))
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        # Eight bytes from every place on.
        eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        active, start, long = slice(None), self.start, self.end - self.start
        while len(start):
            keep = np.minimum(long, 8).astype(U)
            value = eight[start] & (U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * keep))
            hashed[active] = mixed((hashed[active] ^ value) * U(0x9E3779B97F4A7C15) + keep)
            more = long > 8
            active = np.flatnonzero(more) if isinstance(active, slice) else active[more]
            start, long = start[more] + 8, long[more] - 8
        return hashed


def runs(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words; the run from word i is at i. Runs cross text borders."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    weight = numbers(3, k) | U(1)
    total = word_hashes[:n] * weight[0]
    for j in range(1, k):
        total += word_hashes[j : n + j] * weight[j]
    return mixed(total)


def pieces(batches: Iterator[pa.RecordBatch], text: str | int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(sizes):
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


class Sets(NamedTuple):
    """Distinct shingles of texts: text t has ``hashes[first[t]:first[t + 1]]``, ``owner`` names it per hash."""

    hashes: np.ndarray
    owner: np.ndarray
    first: np.ndarray


def shingles(column: pa.Array, k: int, lower: bool = True) -> Sets:
    """Distinct runs of ``k`` words per text; a text with fewer words has its whole sequence as its only one."""
    texts = Texts.of(column)
    if lower:
        texts = Texts(LOWER[texts.data], texts.at)
    words = Words.of(texts)
    hashed = words.hashes(texts.data)
    count = np.diff(words.first)
    windows = np.where(count >= k, count - k + 1, 0)
    owner = np.repeat(np.arange(len(count)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(words.first[:-1], windows)
    found = runs(hashed, k)[place] if len(place) else np.zeros(0, U)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = np.array([runs(hashed[words.first[t] : words.first[t + 1]], int(count[t]))[0] for t in short], U)
        owner = np.concatenate([owner, short])
        found = np.concatenate([found, mixed(whole + count[short].astype(U))])
    bits = max(1, int(len(count)).bit_length())
    order = np.argsort((owner.astype(U) << U(64 - bits)) | (found >> U(bits)))
    owner, found = owner[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    owner, found = owner[new], found[new]
    return Sets(found, owner, np.searchsorted(owner, np.arange(len(count) + 1)))


def per_set(sets: Sets, values: np.ndarray, reduce: np.ufunc, empty: int) -> np.ndarray:
    """``reduce`` over each set's values; ``empty`` where a set has none."""
    out = np.full(len(sets.first) - 1, empty, values.dtype)
    some = np.flatnonzero(np.diff(sets.first))
    if len(some):
        out[some] = reduce.reduceat(values, sets.first[some])
    return out
