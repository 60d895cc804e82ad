import random
from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_quality import junk, prose


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    rows = [row for row in cases.odd_rows() if len(row[1] or "") < 20000]
    r = random.Random(8)
    rows += [(2000 + i, prose(r, r.randrange(60, 200)), "en", f"s{i % 4}", 0) for i in range(150)]
    rows += [(4000 + i, rows[-1 - i][1] + " more", "en", "s2", 0) for i in range(5)]
    rows += [(3000 + i, junk(r, 100), "en", "s1", 0) for i in range(15)]
    rows += [(9000, f"mail und.34@mail7.example.com and {prose(r, 80)}", "en", "s0", 1)] * 2
    docs = cases.table(spark, rows)
    counts = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name == "private":
            texts = [r.text for r in docs.where("doc_id = 9000").collect()]
            assert texts and all("@mail7.example.com" in t and "und.34" not in t for t in texts)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "private", "mixture", "packing"]
    assert len(rows) > counts[0] > counts[1] == counts[2] == counts[3] > 0


def test_windows_hold_the_targets_of_the_mixture(spark):
    r = random.Random(3)
    sizes = {"s0": 120, "s1": 20, "s2": 6, None: 2}
    rows = [(i, prose(r, 400), "en", s, 0) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    chars = Counter()
    for _, text, _, source, _ in rows:
        chars[source or ""] += len(text)
    whole = sum((n + 1) ** 0.7 for n in chars.values())
    got, ends = defaultdict(Counter), Counter()
    for x in corpus_pipeline.packed(spark, cases.table(spark, rows), "").collect():
        got[x.sequence_id][x.queue] += x.length
        ends[x.queue] = max(ends[x.queue], x.sequence_id)
    assert set(ends) == set(chars) and min(ends.values()) >= 2
    for sequence in range(min(ends.values())):
        for queue, n in chars.items():
            assert abs(got[sequence][queue] - 4096 * (n + 1) ** 0.7 / whole) < 2 * len(chars)


def test_empty_table(spark):
    docs = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_run(spark, small):
    packed = corpus_pipeline.run(spark, small)
    assert packed.columns[:3] == ["doc_id", "start", "length"] and packed.count() > 0
