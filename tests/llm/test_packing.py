import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from crawlsight.llm import packing, queries  # noqa: F401
from tests.llm import cases

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def check_pieces(found, rows, window):
    """Every id once, right digests, no gaps, full sequences but for powers of two at the end."""
    wanted = Counter()
    for doc, text, *_ in rows:
        wanted[doc, len(ids := ids_of(text)), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    by_doc = defaultdict(list)
    for x in found:
        by_doc[x.doc_id].append(x)
    for (doc, n, _), times in wanted.items():
        mine = [x for x in by_doc[doc] if x.doc_tokens == n]
        assert sum(x.length for x in mine) >= n * times
        ids = next(ids for d, t, *_ in rows if d == doc and len(ids := ids_of(t)) == n)
        if sum(1 for d, m, _ in wanted if (d, m) == (doc, n)) == 1:
            for x in mine:
                assert x.ids_crc32 == zlib.crc32(np.array(ids[x.start : x.start + x.length], "<u4").tobytes())
            covered = Counter(i for x in mine for i in range(x.start, x.start + x.length))
            assert set(covered.values()) == {times} and len(covered) == n
    ends = defaultdict(list)
    for x in found:
        ends[x.sequence_id].append((x.offset, x.offset + x.length))
    assert sorted(ends) == list(range(len(ends)))
    sizes = []
    for sequence in sorted(ends):
        spans = sorted(ends[sequence])
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        sizes.append(spans[-1][1])
    assert sum(sizes) == sum(n * times for (_, n, _), times in wanted.items())
    rest = [s for s in sizes if s != window]
    assert sizes[: len(sizes) - len(rest)] == [window] * (len(sizes) - len(rest)) and all(s & (s - 1) == 0 for s in rest)


@pytest.mark.parametrize("weights", [None, {"s0": 0.5, "s1": 0.3, "s3": 0.2}])
@pytest.mark.parametrize("most_queues", [256, 2])
def test_odd_tables(spark, weights, most_queues):
    rows = [row for row in cases.odd_rows() if len(row[1] or "") < 20000]
    found = packing.pack(cases.table(spark, rows), PATH, window=64, weights=weights, most_queues=most_queues).collect()
    check_pieces(found, rows, 64)


def test_a_small_source_that_is_named_has_its_weight(spark):
    rows = [(i, "word " * 50, "en", s, 0) for i, s in enumerate(s for s, n in {"a": 90, "b": 80, "c": 40, "z": 30}.items() for _ in range(n))]
    found = packing.pack(cases.table(spark, rows), PATH, window=64, weights={"z": 0.5, "c": 0.25, "a": 0.25}, most_queues=2)
    got = Counter()
    for x in found.where("sequence_id < 20").collect():
        got[x.queue] += x.length
    assert abs(got["z"] - 640) < 64 and sum(got.values()) == 20 * 64
    assert abs(got["a"] - 320) < 64 and abs(got[packing.OTHERS] - 320) < 64


def test_empty_table(spark):
    assert packing.pack(cases.empty(spark), PATH).collect() == []


@pytest.mark.parametrize("weights", [[5, 3, 2], [1, 1, 1], [1000, 1, 1], [3, 5, 2]])
def test_rounds_serve_every_token_once_and_keep_to_the_weights(weights):
    totals, window = [500, 300, 203], 32
    rounds = packing.Rounds(totals, weights, window)
    places = []
    for queue, total in enumerate(totals):
        at = 0
        while at < total:
            for _, token, size, place in rounds.spans(queue, at, min(17, total - at)):
                places += [(place + i, queue, token + i) for i in range(size)]
            at += 17
    places.sort()
    assert [p for p, *_ in places] == list(range(sum(totals)))
    got = [0, 0, 0]
    for _, queue, token in places:
        assert token == got[queue]
        got[queue] += 1
    first_end = min(t * sum(weights) // w for t, w in zip(totals, weights))
    for turn in range(first_end // window):
        assert all(0 <= turn * window * w / sum(weights) - n < 1 for n, w in zip(rounds.before(turn), weights))


def test_words_give_the_same_ids_as_whole_texts():
    encoder = packing.Encoder(PATH, 2)
    texts = ["It's don't I'LL 1234 a1b2", "ÉTÉ été cióñ Straße naïve", "x<|endoftext|>y .. , . a. b,", "ΟΔΟΣ Σίσυφος", "日本 e\u0301a ﬁ", "", "a\u00a0b\x0bc\u2003d"]
    for text in texts:
        flat, _ = encoder.encode(__import__("pyarrow").array([text]))
        assert flat.tolist() == ids_of(text)
