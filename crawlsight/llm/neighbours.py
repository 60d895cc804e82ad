"""Nearest neighbours by multi-index hashing.

1. A rotation is learned on a bounded sample: principal axes, then the rotation that brings the
   vectors closest to the corners of a cube. The signs of a rotated vector are its code.
2. Rows lie in blocks of about ``BLOCK``; a block's index has one table per substring of the code.
3. If two codes differ in at most m * (t + 1) - 1 bits, one of their m substrings differs in at most t.
   So probing every substring with up to t bits flipped finds every code within that radius. t grows
   until enough codes lie within it; those are ranked by the distance of the original vectors.
4. A query's best rows of all blocks are ranked once more.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .words import U

BLOCK, QUERIES = 16384, 4096
FOUND = "query_id long, vec_id long, score double"


class Rotation(NamedTuple):
    """The code of x has a bit for each column of ``axes``: whether (x - mean) @ axes is positive."""

    mean: np.ndarray
    axes: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = np.zeros((len(x), 64), np.uint8)
        bits[:, : self.axes.shape[1]] = (x - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view(U).ravel()


def learn(x: np.ndarray, rounds: int = 30) -> Rotation:
    """Iterative quantisation of the rows of ``x``: up to 64 bits."""
    mean = x.mean(0)
    values, vectors = np.linalg.eigh(np.cov((x - mean).T).reshape(x.shape[1], x.shape[1]) if len(x) > 1 else np.eye(x.shape[1]))
    axes = vectors[:, np.argsort(-values, kind="stable")[:64]]
    low = (x - mean) @ axes
    turn = np.linalg.qr(np.random.default_rng(0).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
        turn = (left @ right).T
    return Rotation(mean, axes @ turn)


def flips(width: int) -> list[np.ndarray]:
    """All masks of ``width`` bits, by how many are set."""
    return [
        np.array([sum(1 << i for i in chosen) for chosen in combinations(range(width), t)], np.int64) for t in range(width + 1)
    ]


class Index:
    """Tables of the substrings of some codes."""

    def __init__(self, codes: np.ndarray, bits: int, tables: int) -> None:
        self.codes = codes
        edges = np.linspace(0, bits, min(tables, bits) + 1).astype(int)
        self.parts = [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]
        self.masks = {width: flips(width) for _, width in self.parts}
        self.rows, self.begin = [], []
        for low, width in self.parts:
            value = self.substring(codes, low, width)
            self.rows.append(np.argsort(value, kind="stable"))
            self.begin.append(np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << width))]))

    @staticmethod
    def substring(codes: np.ndarray, low: int, width: int) -> np.ndarray:
        return (codes >> U(low) & U((1 << width) - 1)).astype(np.int64)

    def within(self, code: np.ndarray, enough: int) -> np.ndarray:
        """Rows of all codes within the smallest probed radius that holds ``enough`` of them (or of all rows)."""
        seen = np.zeros(len(self.codes), bool)
        near = np.zeros(0, np.int64)
        for t in range(max(width for _, width in self.parts) + 1):
            for (low, width), rows, begin in zip(self.parts, self.rows, self.begin):
                if t > width:
                    continue
                values = self.substring(code, low, width)[0] ^ self.masks[width][t]
                start, size = begin[values], begin[values + 1] - begin[values]
                some = size > 0
                start, size = start[some], size[some]
                seen[rows[np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)]] = True
            near = np.flatnonzero(seen)
            apart = np.bitwise_count(self.codes[near] ^ code)
            near = near[apart <= len(self.parts) * (t + 1) - 1]
            if len(near) >= enough:
                break
        return near


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().astype(np.float64).reshape(-1, dim)


def _search(rotation: Rotation, dim: int, k: int, tables: int, enough: int):
    """A block's rows (vec_id, v) and a block of queries (vec_id, v) to each query's k best: FOUND."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if rows.num_rows and queries.num_rows:
            ids, x = rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), dim)
            index = Index(rotation.codes(x), rotation.axes.shape[1], tables)
            asked = _matrix(queries.column("v"), dim)
            codes = rotation.codes(asked)
            # One more than asked for at least, as the query's own row may be among them.
            least = min(len(ids), max(k + 1, enough))
            for i, query in enumerate(queries.column("vec_id").to_pylist()):
                near = index.within(codes[i : i + 1], least)
                near = near[ids[near] != query]
                score = np.sqrt(((x[near] - asked[i]) ** 2).sum(1))
                best = np.lexsort((ids[near], score))[:k]
                for column, values in zip(out, (np.full(len(best), query), ids[near[best]], score[best])):
                    column.append(values)
        return pa.table([np.concatenate(c) if c else [] for c in out], schema=schema)

    return run


def _usable(vector: Column) -> Column:
    """No NULL, no NaN, no infinity, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    sample: int = 20000,
    tables: int = 4,
    enough: int = 512,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found of each row for which ``queries`` holds: query_id, rank, vec_id, score.

    ``score`` is the Euclidean distance of the original vectors, exactly; ties go to the smaller id.
    All rows are indexed; ``sample`` bounds the rows on which the rotation is learned (those of least id
    hash). ``enough`` codes a block, or all it has, must lie within the radius before the search ends;
    more find more.

    Rows with a NULL id and vectors that are NULL, zero, of another length than most, or hold NULL
    or a number that is not finite take no part. Of rows that repeat an id the least vector counts. An empty
    table gives no rows. Other columns do not matter.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"), queries.alias("asked")
    ).where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asked").alias("asked"))
    # One row per length of vector.
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked"))
    lengths = lengths.orderBy(F.desc("n"), "dim").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n, n_asked = lengths[0]
    rows = rows.where(F.size("v") == dim)
    # ``sample`` rows, by the limit.
    told = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    rotation = learn(_matrix(told.column("v"), dim))

    blocks, parts = -(-n // BLOCK), max(1, -(-n_asked // QUERIES))
    place = lambda count, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    data = rows.select("vec_id", "v", place(blocks, 1).alias("block"), every(parts).alias("part"))
    asked = rows.where("asked").select("vec_id", "v", place(parts, 2).alias("part"), every(blocks).alias("block"))
    found = (
        data.groupBy("block", "part")
        .cogroup(asked.groupBy("block", "part"))
        .applyInArrow(_search(rotation, dim, k, tables, enough), FOUND)
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
