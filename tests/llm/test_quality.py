import random
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from crawlsight.llm import quality, queries  # noqa: F401
from tests.llm import cases


def prose(r, n):
    words = [r.choice("the of and to in a house river walk bright seven lamps under stones winter road".split()) for _ in range(n)]
    return " ".join(w + "." if i % 11 == 10 else w for i, w in enumerate(words)) + "."


def junk(r, n):
    words = [r.choice("alpha beta gamma delta".split()) for _ in range(n)]
    return r.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join(w + "###" for w in words), " ".join([words[0]] * n)])


def test_labellers_are_weighed_by_em():
    """Two good labellers, one that guesses: the estimates tell them apart without labels."""
    r = np.random.default_rng(0)
    truth = np.where(r.random(4000) < 0.8, 1, -1)
    says = lambda right: np.where(r.random(4000) < right, truth, -truth)
    votes = np.stack([says(0.95), says(0.9), says(0.85), r.choice([-1, 0, 1], 4000)], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labellers(patterns, counts.astype(float))
    gap = model.says_good[1] - model.says_good[0]
    assert gap[0] > gap[1] > gap[2] > 0.5 and abs(gap[3]) < 0.2
    assert abs(model.prior - 0.8) < 0.05
    assert ((quality.posterior(votes, model) > 0.5) == (truth == 1)).mean() > 0.93


def test_good_stays_and_junk_goes(spark):
    r = random.Random(3)
    rows = [(i, prose(r, r.randrange(40, 200)) if i % 5 else junk(r, r.randrange(60, 200)), "en", "s", 0) for i in range(400)]
    docs = cases.table(spark, rows)
    found = {x.doc_id: x.keep for x in quality.judged(docs).collect()}
    assert found == {i: bool(i % 5) for i in range(400)}
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert {x.doc_id for x in kept.collect()} == {i for i, keep in found.items() if keep}


def test_odd_tables(spark):
    rows = cases.odd_rows()
    found = quality.judged(cases.table(spark, rows))
    assert found.columns == ["doc_id", "n_bad_votes", "score", "keep"]
    told = found.collect()
    assert len(told) == len(rows)
    nothing = {d for d, text, *_ in rows if not cases.words_of(text)}
    assert all(x.score == 0 and not x.keep for x in told if x.doc_id in nothing - {None})
    assert all(0 <= x.score <= 1 for x in told)
    assert len({(x.doc_id, x.score) for x in told if x.doc_id is not None}) == len({d for d, *_ in rows} - {None})
    assert quality.judged(cases.empty(spark)).collect() == []
    assert quality.keep_good(cases.empty(spark)).collect() == []


def test_held_out_labels(spark, small):
    """Labels are not used in training; they tell how good the outcome is."""
    folder = Path(small).parent / "sf0.01"
    judged = queries.QUERIES["op1_quality"](spark, str(folder))
    labels = spark.read.parquet(str(folder / "labels.parquet")).select("doc_id", "quality")
    counts = judged.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {x.quality: x.kept for x in counts}
    assert kept[1] >= 0.99 and kept[0] <= 0.1
