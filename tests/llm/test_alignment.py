import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F

from crawlsight.llm import alignment, queries  # noqa: F401
from tests.llm import cases

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spelt(text, one, two):
    """Tokens of whole texts: [(id, bytes)] of both sides."""
    left = [(i, one.bytes[i]) for i in one.tokenizer.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, two.bytes[i]) for i in two.model.encode(text)]
    return left, right


def expected(rows):
    one, two = alignment.ByteTokens(A), alignment.PieceTokens(B)
    docs, holds = [], Counter()
    for doc, text, *_ in rows:
        left, right = spelt(text, one, two) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if any(b"".join(t for _, t in side) != whole for side in (left, right)):
            left, right = [], []
        ends = []
        for side in (left, right):
            at, found = 0, []
            for _, token in side:
                at += len(token)
                found.append(at)
            ends.append(found)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in both]
        overlaps = 0
        for k, side in enumerate((left, right)):
            g = 0
            for (i, _), end in zip(side, ends[k]):
                while end > both[g]:
                    g += 1
                groups[g][k].append(i)
        j = 0
        for i, end in enumerate(ends[0]):
            begin = end - len(left[i][1])
            overlaps += sum(1 for e, (_, t) in zip(ends[1], right) if e > begin and e - len(t) < end) if len(left) < 3000 else 0
        linked = Counter((a, b) for x, y in groups for a in x for b in y)
        holds.update(linked.keys())
        text_of = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append((doc, len(left), len(right), len(groups), overlaps, linked, text_of))
    best = defaultdict(int)
    for (a, _), n in holds.items():
        best[a] = max(best[a], n)
    out = []
    for doc, na, nb, ng, overlaps, linked, text_of in docs:
        out.append((
            doc, na, nb, ng, sum(linked.values()), overlaps if na < 3000 else None,
            hashlib.sha256(text_of.encode()).hexdigest() if text_of else "",
            sum(t for p, t in linked.items() if holds[p] == best[p[0]]), sum(t * holds[p] for p, t in linked.items()),
        ))
    return out


def answers(frame):
    return [
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_overlaps if r.n_a < 3000 else None, r.groups_sha256, r.n_best, r.count_sum)
        for r in frame.collect()
    ]


def key(row):
    return [str(x) for x in row]


ODD = [
    "<|endoftext|> and <s>x</s> <unk>", "it's  two   spaces", "lines\n\nand \n tabs\t\tx\n", " leading", "trailing ", "   ", " ", "\n", "a b  c　d 　 e",
    "▁under", "x ▁ y", "<0x0A> literal <0xE2>", "日本語のテキスト と mixed123 text", "🙂🙃 emoji👩‍👩‍👧 x", "\x00 nul \x01\x1c \x1f x", "ﬁ ligature é é",
    "1234567 89,10.5", "'s 're don't '", "a\r\nb \r\n c", "\x85 next \x85line", "﻿bom ​ zero ᠎ x",
]


def rows_in():
    rows = cases.odd_rows()
    r = random.Random(4)
    rows += [(900 + i, text, "en", "s", 0) for i, text in enumerate(ODD)]
    letters = "abcé \n\t 　日🙂'.,!0 1  "
    return rows + [(2000 + i, "".join(r.choice(letters) for _ in range(r.randrange(1, 80))), "en", "s", 0) for i in range(150)]


def test_documents_against_whole_texts(spark):
    rows = rows_in()
    found = answers(alignment.align(cases.table(spark, rows), A, B))
    assert sorted(found, key=key) == sorted(expected(rows), key=key)


def test_few_hot_pairs_give_the_same(spark):
    rows = rows_in()[:60]
    docs = cases.table(spark, rows)
    assert sorted(answers(alignment.align(docs, A, B, hot=5)), key=key) == sorted(expected(rows), key=key)
    assert sorted(answers(alignment.align(docs, A, B, hot=1)), key=key) == sorted(expected(rows), key=key)


def test_blocks_of_links(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    one, two = alignment.Remembered(alignment.ByteTokens(A)), alignment.Remembered(alignment.PieceTokens(B))
    x = alignment.aligned(pa.array([t for _, t, *_ in rows_in() if len(t or "") < 20000]), one, two)
    whole = alignment.links(x, 32000)
    monkeypatch.setattr(alignment, "LINKS", 7)
    assert all(np.array_equal(p, q) for p, q in zip(whole, alignment.links(x, 32000)))


def test_forgetting_changes_nothing(spark):
    import pyarrow as pa

    one, two = alignment.Remembered(alignment.ByteTokens(A)), alignment.Remembered(alignment.PieceTokens(B))
    texts = pa.array([t for _, t, *_ in rows_in() if len(t or "") < 20000])
    before = alignment.spelt_groups(alignment.aligned(texts, one, two), alignment.Decimals(60000))
    one.MOST = two.MOST = 3
    assert before == [g for t in texts for g in alignment.spelt_groups(alignment.aligned(pa.array([t.as_py()], pa.string()), one, two), alignment.Decimals(60000))]


def test_digests_are_those_of_the_groups(spark):
    docs = cases.table(spark, rows_in())
    told = alignment.groups(docs, A, B)
    wrong = told.where(F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)) != F.col("groups_sha256"))
    assert wrong.count() == 0 and told.where("groups != ''").count() > 100


def test_empty_table(spark):
    assert alignment.align(cases.empty(spark), A, B).collect() == []
