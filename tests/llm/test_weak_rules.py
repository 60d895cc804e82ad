import math
import random

import numpy as np

from crawlsight.llm import plans_rules, queries, weak_rules  # noqa: F401
from tests.llm import cases
from tests.llm.test_quality import junk, prose


def measures(text):
    words = cases.words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if cases.words_of(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(covered),
        sum(w.lower() in weak_rules.FUNCTION_WORDS for w in words), sum("A" <= c <= "Z" for c in text or ""), sum(w[-1] in ".?!" for w in words),
    )


def rows_in():
    rows = cases.odd_rows()
    r = random.Random(9)
    rows += [(600 + i, " ".join(r.choice("ab#.!") * r.randrange(1, 3) for _ in range(r.randrange(40))), "en", "s", 0) for i in range(60)]
    rows += [(700, "same line\nother\nsame line\n \nsame line\r\nsame line", "en", "s", 0), (701, "a b c a b c a", "en", "s", 0), (702, "x x x x", "en", "s", 0)]
    return rows + [(703, "# $ % & * | < >", "en", "s", 0), (704, "é日🙂 ß", "en", "s", 0), (705, "ab c a bc ab c", "en", "s", 0)]


def test_measures(spark):
    rows = rows_in()
    found = weak_rules.measured(cases.table(spark, rows))
    assert found.columns == ["doc_id", *weak_rules.MEASURES] and {t for _, t in found.dtypes} == {"bigint"}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((doc, *measures(text)) for doc, text, *_ in rows), key=str)


def em(patterns, counts, rounds):
    """The same model in numpy, rule by rule."""
    W, n_rules = weak_rules, patterns.shape[1]
    prior, g, b = W.PRIOR, np.full(n_rules, W.RIGHT_ON_GOOD), np.full(n_rules, W.RIGHT_ON_BAD)

    def posterior():
        odds = np.full(len(patterns), math.log(prior / (1 - prior)))
        for r in range(n_rules):
            odds += np.where(patterns[:, r] > 0, np.log(g[r] / (1 - b[r])), 0) + np.where(patterns[:, r] < 0, np.log((1 - g[r]) / b[r]), 0)
        return 1 / (1 + np.exp(-odds))

    for _ in range(rounds):
        good = posterior() * counts
        bad = counts - good
        prior = float(np.clip((good.sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
        fit = lambda mass, vote, s, least: np.clip((mass @ (patterns == vote) + s * W.SEEN) / (mass @ (patterns != 0) + W.SEEN), least, W.SUREST)
        g, b = fit(good, 1, W.RIGHT_ON_GOOD, W.LEAST_ON_GOOD), fit(bad, -1, W.RIGHT_ON_BAD, W.LEAST_ON_BAD)
    return prior, g, b


def test_accuracies_of_synthetic_votes(spark):
    """Votes drawn with known accuracies: the expression equals numpy, and finds them."""
    r = np.random.default_rng(3)
    on_good, on_bad, says = np.array([0.95, 0.9, 0.97, 0.9, 0.93]), np.array([0.9, 0.7, 0.6, 0.8, 0.5]), np.array([1, 0.9, 0.6, 0.8, 1])
    good = r.random(40000) < 0.7
    right = r.random((40000, 5)) < np.where(good[:, None], on_good, on_bad)
    votes = np.where(right == good[:, None], 1, -1) * (r.random((40000, 5)) < says)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    frame = spark.createDataFrame([(p.tolist(), int(n)) for p, n in zip(patterns, counts)], "votes array<int>, n long")
    m = weak_rules.model(frame, 5, 40).first().m
    prior, g, b = em(patterns, counts.astype(float), 40)
    assert abs(m.prior - prior) < 1e-9 and np.allclose(m.g, g, atol=1e-9) and np.allclose(m.b, b, atol=1e-9)
    assert abs(prior - 0.7) < 0.03 and np.abs(g - on_good).max() < 0.05 and np.abs(b - on_bad).max() < 0.06


def test_verdicts(spark):
    r = random.Random(4)
    rows = [(i, prose(r, r.randrange(60, 300)), "en", "s", 0) for i in range(120)] + [(1000 + i, junk(r, 120), "en", "s", 0) for i in range(12)]
    rows += [(2000, None, None, None, None), (2001, prose(r, 30), "en", "s", 0), (None, prose(r, 100), "en", "s", 0), (2002, "again " * 200, "en", "s", 0)]
    found = weak_rules.judge(cases.table(spark, rows + rows[:2])).collect()
    kept = {x.doc_id: x.kept for x in found}
    assert len(found) == len(rows) + 2
    assert all(kept[i] for i in range(120)) and not any(kept[1000 + i] for i in range(12)) and kept[None]
    assert [kept[i] for i in (2000, 2001, 2002)] == [False] * 3
    assert {x.doc_id for x in found if x.base_failed} >= {2000, 2001, 2002}


def test_one_vote_is_not_a_verdict(spark):
    """A document that fails one rule and passes the others stays; filtering by all rules would lose it."""
    r = random.Random(5)
    rows = [(i, prose(r, 200), "en", "s", 0) for i in range(100)]
    rows += [(500, rows[0][1] + " # * $" * 14, "en", "s", 0)] + [(1000 + i, junk(r, 120), "en", "s", 0) for i in range(10)]
    found = {x.doc_id: x for x in weak_rules.judge(cases.table(spark, rows)).collect()}
    assert -1 in found[500].votes and found[500].kept and not found[1000].kept


def test_held_out_labels(spark):
    """No labels are used; those of the test data are a check."""
    folder = "/root/testdata/sf0.01"
    judged = weak_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    told = judged.join(spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id").where("NOT base_failed")
    shares = {x.label: x.share for x in told.selectExpr("label", "CAST(kept AS int) AS k").groupBy("label").avg("k").withColumnRenamed("avg(k)", "share").collect()}
    assert shares[1] > 0.98 and shares[0] < 0.25


def test_empty_table(spark):
    assert weak_rules.judge(cases.empty(spark)).collect() == []
