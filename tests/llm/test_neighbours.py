import random

import numpy as np
from pyspark.sql import functions as F

from crawlsight.llm import neighbours, queries  # noqa: F401


def brute(rows, k, queries):
    known = [(i, np.array(v, float)) for i, v in rows]
    out = []
    for q, x in known:
        if q in queries:
            best = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in known if i != q)[:k]
            out += [(q, rank, i, round(d, 9)) for rank, (d, i) in enumerate(best, 1)]
    return out


def vectors(n, dim, seed=0):
    r = np.random.default_rng(seed)
    return [(i, r.normal(size=dim).round(3).tolist()) for i in range(n)]


def answers(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in frame.collect())


def test_small_tables_are_exact(spark):
    rows = vectors(300, 16)
    rows += [(1000 + i, rows[10][1]) for i in range(5)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, [float("inf")] * 16), (2005, [1.0])]
    frame = spark.createDataFrame(rows + odd + rows[:3] + [(None, [1.0] * 16)], "vec_id long, embedding array<float>")
    frame = frame.withColumn("rank", F.lit(1)).withColumn("v", F.lit(2)).withColumn("block", F.lit(3))
    found = neighbours.nearest(frame, F.col("vec_id") % 10 == 0, k=7)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    exact = [(i, np.array(v, np.float32)) for i, v in rows]
    assert answers(found) == sorted(brute(exact, 7, {i for i, _ in rows if i % 10 == 0}))


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    found = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], schema), F.col("vec_id") >= 0, k=10)
    assert answers(found) == [(0, 1, 1, round(2**0.5, 9)), (1, 1, 0, round(2**0.5, 9))]
    assert neighbours.nearest(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(5, [1.0])], schema), F.lit(True)).collect() == []


def test_blocks_and_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 700)
    monkeypatch.setattr(neighbours, "QUERIES", 8)
    rows = vectors(3000, 32, 3)
    found = answers(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, enough=200))
    truth = brute(rows, 10, set(range(0, 3000, 100)))
    assert len(found) == len(truth)
    hits = {(q, v) for q, _, v, _ in found} & {(q, v) for q, _, v, _ in truth}
    assert len(hits) >= 0.9 * len(truth)


def test_pigeonhole():
    """Every code within the radius is found, whatever the flipped bits."""
    r = random.Random(1)
    codes = np.array([r.getrandbits(24) for _ in range(500)], np.uint64)
    index = neighbours.Index(codes, 24, 3)
    for _ in range(20):
        code = np.array([r.getrandbits(24)], np.uint64)
        apart = np.bitwise_count(codes ^ code)
        for t in range(3):
            radius = 3 * (t + 1) - 1
            within = set(np.flatnonzero(apart <= radius).tolist())
            if within:
                assert within <= set(index.within(code, len(within)).tolist())
