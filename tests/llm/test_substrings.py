import random

import numpy as np
import pytest

from crawlsight.llm import queries, substrings  # noqa: F401
from tests.llm import cases


def expected(rows, window):
    first = {}
    for doc, text, *_ in rows:
        words = cases.words_of(text)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text, *_ in rows:
        words, gone = cases.words_of(text), set()
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((doc or -1, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out)


def answers(frame):
    return sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept) for r in frame.collect())


@pytest.mark.parametrize(("window", "gram", "most"), [(50, 10, 4096), (8, 3, 4096), (8, 3, 2)])
def test_odd_tables(spark, window, gram, most):
    """``most=2`` sends nearly all anchors the way of crowded ones."""
    rows = cases.odd_rows(3)
    found = substrings.without_repeats(cases.table(spark, rows), window, gram, most)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert answers(found) == expected(rows, window)


def test_repeating_words(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice("ab") for _ in range(60)) + " x" * r.randrange(40), "en", "s", 0) for i in range(30)]
    assert answers(substrings.without_repeats(cases.table(spark, rows), 9, 4)) == expected(rows, 9)


def test_empty_table(spark):
    assert substrings.without_repeats(cases.empty(spark)).collect() == []


def test_backward_search_finds_all_windows():
    r = np.random.default_rng(1)
    symbols = r.integers(1, 4, 400)
    symbols[[90, 200, 399]] = 0
    for window in (2, 5, 7):
        index = substrings.FMIndex(symbols, window)
        begin, size = np.array([0, 91, 201]), np.array([90, 109, 198])
        for part, place, group in index.windows(symbols, begin, size):
            for p, i, g in zip(part, begin[part] + place, group):
                same = [j for j in range(len(symbols) - window + 1) if (symbols[j : j + window] == symbols[i : i + window]).all()]
                low, high = index.full[1][g], index.full[1][g + 1]
                assert sorted(index.suffixes[low:high]) == same
