"""Operators of column functions: host rules, licences, mixing, fingerprints."""

import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from crawlsight.llm import hosts, licenses, mixing, queries, sketches
from tests.compare import connect, differences
from tests.llm import cases


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_checks(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), connect(small), queries.ORACLES[name]) == []


NATIVE = ["op7_source_mix", "op8_fingerprints", "op9_host_reputation", "op10_license_rules", "op11_weak_rules"]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_native_plans(spark, small, name):
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_hosts_and_paths(spark):
    urls = [None, "", "no scheme/x", "http://A.Example.ORG/en/1?x#y", "x://h", "x://h?q/a", "x://h#f", "a://b://c/d", "x:///p", "x://H:80/p/#"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    found = frame.select(hosts.host_of(F.col("url")).alias("h"), hosts.path_of(F.col("url")).alias("p")).collect()
    assert [tuple(r) for r in found] == [
        ("", ""), ("", ""), ("", ""), ("a.example.org", "/en/1"), ("h", ""), ("h", ""), ("h", ""), ("b:", "//c/d"), ("", "/p"), ("h:80", "/p/"),
    ]


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def pages(spark, urls):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for name in ("host", "path", "rule", "verdict", "n", "bad", "m", "best", "floor"):
        frame = frame.withColumn(name, F.lit(name))
    return frame


def test_longest_rule_wins(spark):
    urls = ["x://a.org/", "x://a.org", "x://example.org/es/1", "x://www.example.org/en/17", "x://notexample.org/en/1", "x://b.com/fr/", "x://com/de/x", "x://b.net/de/"]
    nothing = spark.createDataFrame([], "url string, n long, bad long")
    found = hosts.judge_pages(pages(spark, urls + [None] + urls[:1]), nothing, RULES).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in found] == [
        ("org/", "allow"), (None, "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"),
        ("com/fr/", "allow"), ("com/de/", "block"), (None, "allow"), (None, "allow"), ("org/", "allow"),
    ]
    assert hosts.judge_pages(pages(spark, urls).limit(0), nothing, RULES).collect() == []


def test_reputation_shrinks_towards_the_domain(spark):
    told = [("x://bad.net/", 400, 380), ("x://a.worse.com/", 300, 290), ("x://b.worse.com/", 200, 198), ("x://good.org/", 500, 2), ("x://g2.org/", 300, 3)]
    outcomes = spark.createDataFrame(told, "url string, n long, bad long")
    urls = [u for u, *_ in told] + ["x://new.worse.com/", "x://new.good.org/"]
    found = {r.host: r for r in hosts.judge_pages(pages(spark, urls), outcomes, []).collect()}
    assert [found[h].verdict for h in ("bad.net", "a.worse.com", "good.org", "new.good.org")] == ["block", "block", "allow", "allow"]
    assert found["new.worse.com"].badness > 0.7 > 0.2 > found["new.good.org"].badness
    assert found["new.worse.com"].floor < found["b.worse.com"].floor < found["b.worse.com"].badness < 0.99


def test_licences(spark):
    grant, kept, as_is, liable = (k for k, v in licenses.SENTENCES.items() if v in ("mit-grant", "mit-notice-kept", "as-is", "no-liability"))
    mit = f"Copyright (c) 2001 X\n\n{grant.upper()}:\n\n{kept}.\n{as_is}. {liable}."
    texts = [None, "", "plain words", "Released under the MIT License.", mit, f"{mit} Licensed under CC BY-NC 4.0.", f"{grant}. {as_is}.",
             "x. Licensed under the Apache License, Version 2.0. y\nReleased under the MIT License!\nReleased under the MIT License.",
             "Released under the MIT License. " + "word " * 50000]
    frame = cases.table(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, texts[3], None, None, None)] * 2)
    found = {r.doc_id: (r.n_recognised, r.licenses) for r in licenses.find_licenses(frame).collect()}
    assert found == {
        0: (0, []), 1: (0, []), 2: (0, []), 3: (1, ["MIT"]), 4: (4, ["MIT"]), 5: (5, ["CC-BY-NC-4.0", "MIT"]), 6: (2, []),
        7: (3, ["Apache-2.0", "MIT"]), 8: (1, ["MIT"]), None: (1, ["MIT"]),
    }
    assert licenses.find_licenses(cases.empty(spark)).collect() == []


WRAPPED = {
    "MIT": """MIT License

Copyright (c) 2020 Some One
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "GPL-3.0-or-later": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
""",
}


def test_wrapped_licences(spark):
    texts = [w.replace("\n", end) for w in WRAPPED.values() for end in ("\n", "\r\n")]
    lines = ["no mark before\nReleased under the MIT License\nnor after", "Released under the\n\nMIT License", "x Released under the MIT\nLicense"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts + lines)]
    found = licenses.find_licenses(cases.table(spark, rows)).orderBy("doc_id").collect()
    assert [(r.n_recognised, r.licenses) for r in found[:8]] == [
        (n, [name]) for name, n in zip(WRAPPED, (4, 4, 2, 4)) for _ in range(2)
    ]
    assert [r.licenses for r in found[8:]] == [["MIT"], [], []]


@pytest.mark.parametrize("weights", [[1, 1, 1], [5, 3, 1], [90, 1, 9, 30], [1]])
def test_pattern_stays_within_one_block(spark, weights):
    queues = spark.createDataFrame([(f"q{i}", float(w)) for i, w in enumerate(weights)], "queue string, w double")
    shares = mixing.slots_per_period(queues, F.col("w"), 60)
    k = {r.queue: r.k for r in shares.collect()}
    assert sum(k.values()) == 60 and min(k.values()) >= 1
    rows = sorted((r.slot, r.queue, r.turn) for r in mixing.pattern(shares, 60).collect())
    assert [s for s, *_ in rows] == list(range(60))
    served = dict.fromkeys(k, 0)
    for slot, queue, turn in rows:
        assert turn == served[queue]
        served[queue] += 1
        assert all(abs(n - (slot + 1) * k[q] / 60) < 1 for q, n in served.items())


MANY = [0.9] + [0.1 / 256] * 256


@pytest.mark.parametrize("weights", [MANY, [1, 1, 1], [5, 3, 1], [90, 1, 9, 30], [2**-i for i in range(20)], [i**-1.1 for i in range(1, 200)], [1]])
def test_slots_keep_to_the_weights_given(spark, weights):
    slots, whole = 5000, sum(weights)
    share = {f"q{i}": w / whole for i, w in enumerate(weights)}
    blocks = spark.createDataFrame([(q, i) for q, w in share.items() for i in range(int(w * slots) + 3)], "queue string, block long")
    release, deadline = mixing.window_of(F.col("block"))
    found = blocks.join(mixing.schedule(spark, {f"q{i}": float(w) for i, w in enumerate(weights)}), "queue")
    found = found.select("queue", "block", mixing.slot_of(F.col("block")), release, deadline).collect()
    assert all(low <= slot < high for _, _, slot, low, high in found)
    taken = sorted((slot, queue, block) for queue, block, slot, _, _ in found if slot < slots)
    assert [slot for slot, *_ in taken] == list(range(slots))
    served = dict.fromkeys(share, 0)
    for slot, queue, block in taken:
        assert block == served[queue]
        served[queue] += 1
        if slot % 7 == 0 or slot > slots - 10:
            assert all(abs(n - (slot + 1) * share[q]) < 1.75 for q, n in served.items())


def test_a_named_source_gets_the_share_it_was_given(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x" * 100).alias("text"), F.when(F.col("id") % 2 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 200)).alias("source"))
    weights = {"big": 0.9} | {f"s{i}": 0.001 for i in range(1, 200, 2)}
    found = mixing.mix(docs, weights=weights, block=100).where("slot < 2000").groupBy("queue").count().collect()
    found = {r.queue: r["count"] for r in found}
    assert abs(found.pop("big") - 1800) < 2 and len(found) == 100 and all(abs(n - 2) < 2 for n in found.values())


def test_a_small_source_that_is_named_has_its_weight(spark):
    # The largest sources are not named; the lifted one is the smallest, and two that share a queue weigh as two.
    rows = [(i, "x" * 100, "en", s, 0) for i, s in enumerate(s for s, n in {"a": 900, "b": 800, "c": 400, "d": 400, "z": 300}.items() for _ in range(n))]
    docs = cases.table(spark, rows)
    weights = {"z": 0.5, "c": 0.25, "d": 0.25}
    found = mixing.mix(docs, weights=weights, block=100, most_queues=2).where("slot < 400").groupBy("queue").count().collect()
    found = {r.queue: r["count"] for r in found}
    assert abs(found["z"] - 200) < 2 and abs(found["c"] - 100) < 2 and abs(found[mixing.OTHERS] - 100) < 2
    told = mixing.mix(docs, exponent=0.0, block=100, most_queues=2).where("slot < 1000").groupBy("queue").count().collect()
    assert abs({r.queue: r["count"] for r in told}[mixing.OTHERS] - 600) < 2


@pytest.mark.parametrize("how", [{}, {"weights": {"s0": 0.7, "s1": 0.3}}, {"most_queues": 1}])
def test_mixing_keeps_all_rows_in_their_windows(spark, how):
    rows = cases.odd_rows()
    docs = cases.table(spark, rows)
    found = mixing.mix(docs, block=500, period=40, **({"most_queues": 5} | how)).collect()
    key = lambda d: -1 if d is None else d
    assert sorted(key(r.doc_id) for r in found) == sorted(key(d) for d, *_ in rows)
    assert all(r.release <= r.slot < r.deadline for r in found)
    slots = {}
    for r in found:
        assert slots.setdefault(r.slot, (r.queue, r.block)) == (r.queue, r.block)
    sizes = {}
    for d, text, _, source, _ in rows:
        queue = mixing.OTHERS if how.get("most_queues") == 1 and (source or "") != max_source(rows) else source or ""
        sizes[queue] = sizes.get(queue, 0) + len(text or "")
    for queue, size in sizes.items():
        assert max(r.start for r in found if r.queue == queue) <= size
    ordered = mixing.mixed_order(docs, block=500, period=40, **({"most_queues": 5} | how))
    assert ordered.schema.names == docs.schema.names
    place = {}
    for r in found:
        place.setdefault(key(r.doc_id), (r.slot, r.start))
    at = [place[key(r.doc_id)] for r in ordered.where("doc_id IS NOT NULL").collect()]
    assert len(at) == sum(d is not None for d, *_ in rows) and [s for s, _ in at] == sorted(s for s, _ in at)
    assert mixing.mix(cases.empty(spark)).collect() == [] and mixing.mixed_order(cases.empty(spark)).collect() == []


def max_source(rows):
    total = {}
    for _, text, _, source, _ in rows:
        total[source or ""] = total.get(source or "", 0) + len(text or "")
    return min(total, key=lambda s: (-total[s], s))


def paragraphs(text):
    """Words up to a line's end, a last letter of the set, or the greatest length."""
    found = set()
    for line in (text or "").split("\n"):
        run = []
        words = [(m[0], m.end() == len(line)) for m in re.finditer(r"[^\x20\x09-\x0D]+", line)]
        blanks = re.findall(r"[\x20\x09\x0B-\x0D]+", line.lstrip("\x20\x09\x0B\x0C\x0D"))
        for i, (word, _) in enumerate(words):
            run.append(word)
            code = ord(word[-1])
            if i == len(words) - 1 or len(run) == 2 * sketches.LONGEST - 1 or (0x21 <= code < 0x530 and code % 8 == 3):
                found.add("".join(run))
                run = []
            else:
                run.append(blanks[i])
    return found


def near(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    rows = [r for r in cases.odd_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    told = sketches.edited_fingerprints(cases.table(spark, rows)).persist()
    found = {r.doc_id: r for r in told.collect()}
    assert len(found) == len(rows)
    rows.sort()
    prints = {}
    for i, (doc, text, *_) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[doc]
        assert r.edited == edited and r.n_chars == len(text)
        assert r.near_edited == pytest.approx(near(text, edited)) and r.near_next == pytest.approx(near(text, after))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
    # The same from the two fingerprints alone.
    again = sketches.differing(told.select("doc_id", "fingerprint", "edited_fingerprint"), "doc_id", "fingerprint", "edited_fingerprint")
    assert all(r.complete and r.likeness == pytest.approx(found[r.doc_id].near_edited) for r in again.collect())


def test_one_word_changes_few_paragraphs(spark):
    r = random.Random(3)
    line = " ".join("".join(r.choice("aeidlmnorstuk") for _ in range(5)) for _ in range(240))
    rows = [(1, "word " + line, "en", "s", 0), (2, line, "en", "s", 0)]
    found = sketches.edited_fingerprints(cases.table(spark, rows)).where("doc_id = 1").first()
    assert found.near_next == pytest.approx(near(rows[0][1], line)) and found.near_next > 0.8


def test_fingerprints_of_odd_tables(spark):
    assert sketches.edited_fingerprints(cases.empty(spark)).collect() == []
    rows = cases.odd_rows()
    assert sketches.edited_fingerprints(cases.table(spark, rows)).count() == len(rows)
    one = sketches.edited_fingerprints(cases.table(spark, [(5, "abcd", "en", "s", 4)])).collect()
    assert [(r.edited, r.near_next) for r in one] == [("abab", 1.0)]


def test_fingerprints_give_back_the_differing_digests(spark):
    rows = []
    for n in (0, 1, 5, 30, 700):
        for common in (0, 7, 200):
            shared = [f"c{i}a" for i in range(common)]
            rows.append((len(rows), "\n".join(shared + [f"l{i}a" for i in range(n)]), "\n".join(shared + [f"r{i}a" for i in range(n // 9)])))
    texts = spark.createDataFrame([(2 * i + k, t, "en", "s", 0) for i, *both in rows for k, t in enumerate(both)], cases.SCHEMA)
    prints = sketches.edited_fingerprints(texts).select("doc_id", "fingerprint")
    sides = [prints.where(F.col("doc_id") % 2 == k).select(F.expr("doc_id div 2").alias("pair"), F.col("fingerprint").alias(name)) for k, name in ((0, "left"), (1, "right"))]
    found = {r.pair: r for r in sketches.differing(sides[0].join(sides[1], "pair"), "pair").collect()}
    known = lambda text: {r[0] for r in spark.createDataFrame([(text,)], "t string").select(F.explode(sketches.digests(F.col("t")))).collect()}
    for i, left, right in rows:
        a, b = known(left), known(right)
        assert found[i].complete and (set(found[i].only_left), set(found[i].only_right)) == (a - b, b - a)
        assert found[i].likeness == pytest.approx(near(left, right))
    assert sketches.differing(prints.limit(0), "doc_id", "fingerprint", "fingerprint").collect() == []
    odd = spark.createDataFrame([(1, None, None), (2, None, "0")], "pair long, left string, right string")
    assert [r.likeness for r in sketches.differing(odd, "pair").collect()] == [1.0, 1.0]


def test_paragraph_ends_are_found_in_a_few_steps(spark):
    chars = spark.range(0x21, 0x2000).select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    found = {r.id for r in chars.where(F.col("c").rlike(f"[{sketches.ENDS}]")).collect()}
    assert found == {code for code in range(0x21, 0x530) if code % 8 == 3}
    # A class tries its characters beyond Latin-1 one after the other, for each word of a text.
    beyond = r"(?:\\u(?!00)[0-9a-f]{4}(?!-))+"
    assert max(len(run) // 6 for run in re.findall(beyond, sketches.ENDS)) <= 16


def test_fingerprints_are_printed_without_moving_cells(spark):
    r = random.Random(7)
    sets = [[], [5], *([r.getrandbits(63) - 2**62 for _ in range(n)] for n in (8, 9, 33, 64, 3000))]
    frame = spark.createDataFrame(list(enumerate(sets)), "id int, digest array<bigint>")
    told = frame.select("id", sketches.as_text(F.col("digest")).alias("print"))
    assert not re.search("Aggregate|Exchange|Generate", told._jdf.queryExecution().executedPlan().toString())
    found = {row.id: row["print"] for row in told.collect()}
    x, size = F.col("x"), F.size("digest")
    places = [F.struct(F.lit(t).alias("t"), sketches._cell(x, sketches.width(size, t), row, t).alias("c")) for t in (0, 1) for row in range(3)]
    cells = {i: {} for i in range(len(sets))}
    for row in frame.select("id", size.alias("n"), "digest", F.explode("digest").alias("x")).select("id", "x", F.inline(F.array(*places))).collect():
        n, xor = cells[row.id].get((row.t, row.c), (0, 0))
        cells[row.id][row.t, row.c] = n + 1, xor ^ row.x
    assert any(n > 2 for n, _ in cells[6].values())
    for i, digests in enumerate(sets):
        entries = [f"{t}.{c:X}.{n:X}.{xor & (2**64 - 1):x}" for (t, c), (n, xor) in sorted(cells[i].items())]
        assert found[i] == f"{len(digests):X} " + " ".join(entries)


def test_rounds_of_peeling_meet_by_short_keys(spark):
    docs = cases.table(spark, [(i, f"a{i}c b{i}c", "en", "s", 0) for i in range(3)])
    rows = sketches.with_next(docs, "doc_id", "text").withColumn("edited", F.col("text"))
    plan = sketches._sizes(rows, 0)._jdf.queryExecution().executedPlan().toString()
    keys = [names.count(",") + 1 for names in re.findall(r"HashAggregate\(keys=\[([^\]]+)\], functions=\[(?:partial_)?sum\(n#", plan)]
    assert keys and max(keys) <= 3


def test_texts_are_dealt_by_size_and_cut_once(spark, monkeypatch):
    rows = [(700 * i, " ".join(f"w{i}c{j}c" for j in range(40)), "en", "s", 0) for i in range(30)] + [(None, None, None, None, None)]
    docs = cases.table(spark, rows)
    whole = {tuple(r) for r in sketches.edited_fingerprints(docs).collect()}
    monkeypatch.setattr(sketches, "PORTION", 1000)
    n = sketches.portions(docs, "text")
    assert n == sum(len(text or "") + 64 for _, text, *_ in rows) // 1000 + 1
    dealt = sketches.with_next(docs, "doc_id", "text")
    assert dealt.select(F.spark_partition_id().alias("part")).distinct().count() > 5
    assert {tuple(r) for r in sketches.edited_fingerprints(docs).collect()} == whole
    # A text's paragraphs are those of the row before's next text too.
    plan = sketches._sizes(dealt.withColumn("edited", F.col("text").substr(1, 9)), 0)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_extract_all\(", plan)) == 2


def test_second_try_and_printing_share_the_dealt_texts(spark, small):
    found = queries.QUERIES["op8_fingerprints"](spark, small)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert len(re.findall(r"ReusedExchange \[doc_id#[^\n]*REPARTITION_BY_NUM", plan)) == 1


def test_pairs_without_cells_go_on_as_counts(spark):
    rows = [(i, " ".join(f"a{i}d{j}c" for j in range(1 + i * 7 % 60)), "en", "s", 0) for i in range(120)]
    docs = sketches.with_next(cases.table(spark, rows), "doc_id", "text").withColumn("edited", F.concat("text", F.lit("\nmore")))
    cells, keys = sketches._pairs(docs, 0).persist(), ["slice"]
    counts = lambda peeled: sorted(tuple(r) for r in sketches._counts(peeled, keys).collect())
    peeled, counted = sketches._peeled(cells, keys, 0), sketches._peeled(cells, keys, 0, counted=True).persist()
    assert counts(counted) == counts(peeled) and len(counts(peeled)) == 240
    kinds = dict(counted.groupBy(sketches._kind()).count().collect())
    assert kinds[sketches.COUNTED] > 200 and kinds.get(sketches.FOUND, 0) < peeled.count() / 2


def test_order_of_documents_across_slices(spark):
    ids = [0, 3, 1023, 1024, 5000, 5001, 10**9, 10**12, -7]
    rows = [(i, f"text {i}", "en", "s", 0) for i in ids]
    found = {r.doc_id: r.following for r in sketches.with_next(cases.table(spark, rows), "doc_id", "text").collect()}
    ids.sort()
    assert found == {i: f"text {j}" for i, j in zip(ids, ids[1:] + ids[:1])}


SETS = [MANY, [1, 1, 1], [5, 3, 1], [90, 1, 9, 30], [2.0**-i for i in range(20)], [i**-1.1 for i in range(1, 60)], [1], [0, 0, 1, 3], [0, 0]]


@pytest.mark.parametrize("weights", [*SETS, *([random.Random(n).random() ** 3 for _ in range(8)] for n in range(3))])
def test_slots_are_dealt_by_earliest_deadline(spark, weights):
    """Periods put together are one walk along all slots, less than a block off the weights while all queues last."""
    r = random.Random(len(weights))
    blocks = [r.randint(1, 2000 // len(weights) + 1) for _ in weights]
    names = [f"q{i:03}" for i in range(len(weights))]
    found = mixing.slots(spark, dict(zip(names, weights)), dict(zip(names, blocks)), period=50, together=3).collect()
    found.sort(key=lambda r: r.slot)
    assert [r.slot for r in found] == list(range(sum(blocks)))
    assert all(r.release <= r.slot < r.deadline for r in found)
    # One walk.
    waiting, open_now, walked = sorted((r.release, r.queue, r.block, r.deadline) for r in found), [], []
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            _, queue, block, deadline = waiting.pop(0)
            heapq.heappush(open_now, (deadline, queue, block))
        walked.append(heapq.heappop(open_now)[1:])
    assert [(r.queue, r.block) for r in found] == walked
    # The line as fractions, to the end of the first queue.
    whole = sum(weights) or len(weights)
    share = {name: (w if sum(weights) else 1) / whole for name, w in zip(names, weights)}
    first = min(int(n / share[name]) for name, n in zip(names, blocks) if share[name])
    served = dict.fromkeys(names, 0)
    for slot, (queue, block) in enumerate(walked):
        assert block == served[queue]
        served[queue] += 1
        if slot < first:
            assert all(abs(n - (slot + 1) * share[q]) < 1 + 1e-4 for q, n in served.items())
    assert served == dict(zip(names, blocks))


def test_mixing_is_less_than_a_block_off_its_targets(spark):
    r = random.Random(5)
    weights = {f"s{i}": r.random() ** 2 for i in range(8)}
    rows = [(i, "x" * 100, "en", f"s{i % 8}", 0) for i in range(4000)]
    found = mixing.mix(cases.table(spark, rows), weights=weights, block=100, period=64).collect()
    share = {s: w / sum(weights.values()) for s, w in weights.items()}
    served = dict.fromkeys(share, 0)
    for row in sorted(found, key=lambda r: (r.slot, r.start))[: int(500 / max(share.values()))]:
        served[row.queue] += 1
        assert all(abs(n - (row.slot + 1) * share[q]) < 1 + 1e-4 for q, n in served.items())
