"""Quality without labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer.

1. Labellers look at counts of a text and vote: 1 good, -1 bad, 0 no opinion.
2. Votes are counted per pattern (3^labellers patterns at most, whatever the number of documents).
   Expectation maximisation over these counts finds how each labeller votes on good and bad texts.
3. Posteriors of a bounded sample of documents train a logistic scorer on hashed word features.
4. The scorer judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LOWER, Texts, U, Words, mixed, numbers, pieces

# Frequent function words of the four languages.
STOPWORDS = (
    "the of and to in is that it was for on are as with be at by this from or an a not have they "
    "le la les de des du et un une est que qui dans pour pas sur au avec par en "
    "der die das und ist nicht von mit den dem ein eine zu im auf für sich auch es "
    "el los las y una por con para del se su lo como que en no al"
)
LABELLERS = ("symbols", "capitals", "repeats", "stopwords", "sentences", "marks", "variety", "length")
FEATURES = 1024


def _class(characters: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[ord(c) for c in characters]] = 1
    return table


SYMBOLS, CAPITALS = _class("#$%&*|<>{}[]\\^~_=+@"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTERS = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LETTERS[128:] = 1
# Of a byte: 0 other, 1 small letter, 2 capital, 3 digit, 4 above ASCII, 5 sentence mark, 6 symbol.
KIND = np.zeros(256, np.int64)
KIND[97:123], KIND[65:91], KIND[48:58], KIND[128:] = 1, 2, 3, 4
KIND[[33, 46, 63]] = 5
KIND[SYMBOLS > 0] = 6


class Counted(NamedTuple):
    """Words of a batch of texts: hashes in lower case, the text of each, words per text."""

    texts: Texts
    words: Words
    hashes: np.ndarray
    owner: np.ndarray
    n: np.ndarray


def counted(column: pa.Array) -> Counted:
    texts = Texts.of(column)
    words = Words.of(texts)
    n = np.diff(words.first)
    return Counted(texts, words, words.hashes(LOWER[texts.data]), np.repeat(np.arange(len(n)), n), n)


def _stop_hashes() -> np.ndarray:
    column = pa.array([STOPWORDS])
    texts = Texts.of(column)
    return np.unique(Words.of(texts).hashes(texts.data))


STOPS = _stop_hashes()


def measured(c: Counted) -> dict[str, np.ndarray]:
    """Shares from 0 to 1 of each text, by what they measure."""
    n_texts = len(c.n)
    n = np.maximum(c.n, 1)
    data, (start, end, _) = c.texts.data, c.words
    sums = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[c.texts.at])
    per_word = lambda flags: np.bincount(c.owner, flags, n_texts) / n
    again = np.zeros(len(c.hashes))
    again[1:] = (c.hashes[1:] == c.hashes[:-1]) & (c.owner[1:] == c.owner[:-1])
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    second = data[np.maximum(end - 2, start)] if len(end) else last
    bare = (end - start == 1) & (last == 124)
    shouted = (end - start > 2) & (last == 33) & (second == 33)
    order = np.lexsort((c.hashes, c.owner))
    new = np.ones(len(order), bool)
    new[1:] = (c.hashes[order][1:] != c.hashes[order][:-1]) | (c.owner[order][1:] != c.owner[order][:-1])
    return {
        "symbols": sums(SYMBOLS) / np.maximum(np.diff(c.texts.at), 1),
        "capitals": sums(CAPITALS) / np.maximum(sums(LETTERS), 1),
        "repeats": per_word(again),
        "stopwords": per_word(np.isin(c.hashes, STOPS)),
        "sentences": per_word((last == 46) | (last == 63) | ((last == 33) & (second != 33))),
        "marks": per_word(bare | shouted),
        "variety": np.bincount(c.owner[order][new], minlength=n_texts) / n,
    }


def votes(c: Counted, m: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """One row per text, one column per labeller."""
    m = m or measured(c)

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, -1, np.where(good, 1, 0))

    some, many = c.n >= 20, c.n >= 50
    table = [
        vote((m["symbols"] > 0.06) & some, m["symbols"] < 0.01),
        vote((m["capitals"] > 0.5) & some, m["capitals"] < 0.2),
        vote((m["repeats"] > 0.3) & some, (m["repeats"] < 0.1) & some),
        vote((m["stopwords"] < 0.03) & some, (m["stopwords"] > 0.1) & some),
        vote(((m["sentences"] < 0.004) | (m["sentences"] > 0.6)) & many, (m["sentences"] > 0.02) & (m["sentences"] < 0.4)),
        vote((m["marks"] > 0.1) & some, (m["marks"] < 0.01) & some),
        vote((m["variety"] < 0.2) & many & (c.n < 5000), (m["variety"] > 0.4) & some),
        vote(c.n < 1, (c.n >= 20) & (c.n <= 50000)),
    ]
    return np.stack(table, 1)


class Model(NamedTuple):
    """prior: share of good texts; says_good[y, labeller]: how often a labeller that votes calls bad (0) and good (1) texts good."""

    prior: float
    says_good: np.ndarray


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Model:
    """EM over vote patterns and how often each occurs. No opinion tells nothing; all labellers start as fairly accurate."""
    says_good = np.tile(np.array([[0.4], [0.95]]), (1, patterns.shape[1]))
    prior, total = 0.8, counts.sum()
    if not total:
        return Model(prior, says_good)
    for _ in range(rounds):
        good = posterior(patterns, Model(prior, says_good))
        old = says_good
        prior = float(np.clip((good @ counts + 1) / (total + 2), 0.01, 0.99))
        says_good = np.stack(
            [(mass @ (patterns == 1) + 0.5) / (mass @ (patterns != 0) + 1) for mass in ((1 - good) * counts, good * counts)]
        )
        if np.abs(says_good - old).max() < 1e-6:
            break
    return Model(prior, says_good)


def posterior(patterns: np.ndarray, model: Model) -> np.ndarray:
    """How likely a text with these votes is good."""
    for_good, for_bad = np.log(model.says_good[1] / model.says_good[0]), np.log((1 - model.says_good[1]) / (1 - model.says_good[0]))
    odds = (patterns == 1) @ for_good + (patterns == -1) @ for_bad + np.log(model.prior / (1 - model.prior))
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def word_features(c: Counted) -> list[np.ndarray]:
    """Per word: the hashed number of the word, of its shape, and of whether it repeats the one before."""
    data, (start, end, _) = c.texts.data, c.words
    again = np.zeros(len(c.hashes), np.int64)
    again[1:] = (c.hashes[1:] == c.hashes[:-1]) & (c.owner[1:] == c.owner[:-1])
    if not len(start):
        return [np.zeros(0, np.int64)] * 3
    kind = lambda at: KIND[data[at]]
    shape = kind(start)
    for at in (np.minimum(start + 1, end - 1), np.maximum(end - 2, start), end - 1):
        shape = shape * 7 + kind(at)
    shape = shape * 8 + np.minimum(end - start, 7)
    return [_hashed(c.hashes, 21), _hashed(shape, 22), _hashed(again, 23)]


def text_features(m: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Per text: the hashed number of each measure's twentieth."""
    return [_hashed(np.minimum(m[name] * 20, 19).astype(np.int64), 31 + i) for i, name in enumerate(m)]


def _hashed(x: np.ndarray, seed: int) -> np.ndarray:
    return (mixed(x.astype(U) + numbers(seed, 1)[0]) % U(FEATURES)).astype(np.int64)


def _trust(n: np.ndarray) -> np.ndarray:
    """How much a text's shares are believed: little for a few words, so that short texts are judged by the bias."""
    return n / (n + 20.0)


def rows_of_features(c: Counted, m: dict[str, np.ndarray]) -> np.ndarray:
    """Dense rows: the share of a text's words with each hashed feature, and the text's own features."""
    n = len(c.n)
    out = np.zeros((n, FEATURES), np.float32)
    for feature in word_features(c):
        out += np.bincount(c.owner * FEATURES + feature, minlength=out.size).reshape(out.shape)
    out /= np.maximum(c.n, 1)[:, None]
    for feature in text_features(m):
        out[np.arange(n), feature] += 1
    return out * _trust(c.n)[:, None].astype(np.float32)


def fit_scorer(x: np.ndarray, target: np.ndarray, rounds: int = 12, penalty: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression with soft targets by Newton steps; the bias is not penalised."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x
        curve[np.diag_indices(len(w))] += ridge
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def scores(c: Counted, w: np.ndarray, bias: float, m: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """How likely each text is good, by the scorer; 0 for a text without words."""
    total = np.zeros(len(c.n))
    for feature in word_features(c):
        total += np.bincount(c.owner, w[feature], len(c.n))
    total /= np.maximum(c.n, 1)
    for feature in text_features(m or measured(c)):
        total += w[feature]
    return np.where(c.n > 0, 1 / (1 + np.exp(-np.clip(total * _trust(c.n) + bias, -30, 30))), 0.0)


def _votes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        found, count = np.unique(votes(counted(batch.column("text"))), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.tolist(), pa.list_(pa.int64())), pa.array(count)], ["votes", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vote patterns and hashed features, never more than FEATURES numbers a text."""
    for batch in pieces(batches, "text"):
        c = counted(batch.column("text"))
        m = measured(c)
        table = rows_of_features(c, m)
        rows = [np.flatnonzero(row) for row in table]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(votes(c, m).tolist(), pa.list_(pa.int64())),
                pa.array([r.tolist() for r in rows], pa.list_(pa.int64())),
                pa.array([table[i][r].tolist() for i, r in enumerate(rows)], pa.list_(pa.float32())),
            ],
            ["votes", "place", "share"],
        )


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, sample: int = 4096, doc_id: str = "doc_id", text: str = "text") -> Scorer:
    """Train on ``docs``. ``sample`` bounds the documents that train the scorer, those of smallest id hash;
    vote patterns are counted over all documents."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    width = len(LABELLERS)
    told = rows.select("text").mapInArrow(_votes_of, "votes array<long>, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    patterns = np.array([r.votes for r in told], int).reshape(-1, width)
    model = fit_labellers(patterns, np.array([r.n for r in told], float))
    # ``sample`` ids, by the limit.
    chosen = rows.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    examples = (
        rows.join(F.broadcast(chosen), "doc_id", "left_semi")
        .select("text")
        .mapInArrow(_examples, "votes array<long>, place array<long>, share array<float>")
        .limit(sample)
        .toArrow()
    )
    n = examples.num_rows
    if not n:
        return Scorer(np.zeros(FEATURES), 0.0)
    flat = lambda name: pc.list_flatten(examples.column(name).combine_chunks()).to_numpy(zero_copy_only=False)
    x = np.zeros((n, FEATURES), np.float32)
    x[np.repeat(np.arange(n), pc.list_value_length(examples.column("place")).to_numpy()), flat("place")] = flat("share")
    return Scorer(*fit_scorer(x, posterior(flat("votes").reshape(n, width), model)))


def judged(
    docs: DataFrame, sample: int = 4096, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bad_votes, score, keep.

    ``score`` is the scorer's probability that a document is good; ``keep`` is ``score >= threshold``.
    A NULL or empty text has score 0 and is not kept. Rows with a NULL id are judged but never train.
    Ties do not matter, repeated rows are judged one by one, an empty table gives no rows, other
    columns do not matter.
    """
    scorer = fit(docs, sample, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            c = counted(batch.column("text"))
            m = measured(c)
            score = scores(c, *scorer, m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array((votes(c, m) < 0).sum(1)), pa.array(score), pa.array(score >= threshold)],
                ["doc_id", "n_bad_votes", "score", "keep"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bad_votes long, score double, keep boolean")


def keep_good(
    docs: DataFrame, sample: int = 4096, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without the documents that the scorer rejects (see ``judged``); columns as they were."""
    scorer = fit(docs, sample, doc_id, text)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            yield batch.filter(pa.array(scores(counted(batch.column(at)), *scorer) >= threshold))

    return docs.mapInArrow(run, docs.schema)
