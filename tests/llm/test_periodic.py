import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crawlsight.llm import periodic, plans_text, queries  # noqa: F401
from tests.llm import cases


def brute(words, least=6, exponent=4):
    """(start, length, period) of all maximal runs, by trying all periods."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, exponent * p):
                found.setdefault((i, j - i + p), p)
            i = j
    return sorted((s, length, p) for (s, length), p in found.items())


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def runs_of(lists, **how):
    first = np.cumsum([0] + [len(x) for x in lists])
    found = periodic.runs_of(np.array([w for x in lists for w in x], np.uint64), first, **how)
    out = [[] for _ in lists]
    for text, *run in zip(*found):
        out[text].append(tuple(map(int, run)))
    return out


def repetitive(r):
    words = [r.randrange(3) for _ in range(r.randrange(0, 30))]
    for _ in range(r.randrange(4)):
        unit = [r.randrange(3) for _ in range(r.randrange(1, 30))]
        words += (unit * 12)[: r.randrange(1, 6 * len(unit))] + [r.randrange(3) for _ in range(r.randrange(6))]
    return words


@pytest.mark.parametrize("how", [{}, {"least": 2, "exponent": 2}, {"least": 1, "exponent": 3}, {"least": 40, "exponent": 4}])
def test_runs_against_brute_force(how):
    r = random.Random(1)
    lists = [repetitive(r) for _ in range(150)] + [[], [1], [1] * 5, [1] * 6, [1, 2] * 4, [1] * 500, [1, 2, 3] * 200]
    assert runs_of(lists, **how) == [brute(x, **{"least": 6, "exponent": 4} | how) for x in lists]


@settings(deadline=None, max_examples=80)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5))
def test_runs_of_any_words(lists):
    assert runs_of(lists, least=2, exponent=2) == [brute(x, 2, 2) for x in lists]


def test_grids_in_blocks(monkeypatch):
    r = random.Random(2)
    lists = [repetitive(r) for _ in range(60)]
    monkeypatch.setattr(periodic, "PLACES", 8)
    assert runs_of(lists) == [brute(x) for x in lists]


def test_extensions():
    r = random.Random(3)
    for n in (1, 2, 20, 21, 22, 100, 700):
        symbols = np.array([r.randrange(2) for _ in range(n)] * 2 + [9])
        x = periodic.Extensions(symbols)
        pairs = [(a, b) for a in range(0, len(symbols), 1 + n // 30) for b in range(len(symbols)) if a != b]
        a, b = np.array(pairs).T
        for i, j, got in zip(a.tolist(), b.tolist(), x.common(a, b).tolist()):
            want = 0
            while max(i, j) + want < len(symbols) and symbols[i + want] == symbols[j + want]:
                want += 1
            assert got == want


def test_covers_all_differences():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def rows_in():
    rows = cases.odd_rows()
    r = random.Random(6)
    unit = cases.sentence(r, 900)
    rows += [(700 + i, " \n".join(f"w{x}" for x in repetitive(r)), "en", "s", 0) for i in range(60)]
    rows += [(800, "x " * 20000, "en", "s", 0), (801, f"{unit} " * 30, "en", "s", 0), (802, "日本\x0bé " * 9, "en", "s", 0)]
    return rows + [(900 + i, cases.sentence(r, r.randrange(1, 90)), "en", "s", 0) for i in range(60)]


def test_documents(spark):
    rows = rows_in()
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.collapse_runs(cases.table(spark, rows)).collect()]
    expected = []
    for doc, text, *_ in rows:
        words = cases.words_of(text)
        runs = brute(words) if len(words) < 3000 else None
        if runs is None:
            runs = {800: [(0, 20000, 1)], 801: [(0, 27000, 900)]}.get(doc, [])
        expected.append((doc, len(words), runs, collapsed(words, runs)))
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_query(spark, tmp_path):
    """The whole contract, planted repetitions included."""
    rows = [row for row in rows_in() if row[0] not in (800, 801) and len(row[1] or "") < 20000 and row[0] is not None]
    cases.table(spark, rows, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for doc, text, *_ in rows:
        words = cases.words_of(text)
        n, h = len(words), zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else None
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        expected.append((doc, len(runs), *told, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs)))))
    found = plans_text.op12_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for c, t in found.dtypes if c in names] == ["bigint"] * 6 + ["string"] * 2
    assert sorted((tuple(r) for r in found.select(names).collect()), key=str) == sorted(expected, key=str)
    assert sum(e[1] > 0 for e in expected) > 20


def test_empty_table(spark):
    assert periodic.collapse_runs(cases.empty(spark)).collect() == []
