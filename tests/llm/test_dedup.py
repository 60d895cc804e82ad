import random

from crawlsight.llm import components, dedup, queries  # noqa: F401
from tests.llm import cases


def expected(rows, k, percent):
    """doc_id -> component, by comparing all pairs."""
    sets = []
    for doc, text, *_ in rows:
        words = cases.words_of(cases.lowered(text))
        found = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}
        sets.append((doc, found))
    root = {doc: doc for doc, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted((doc, len(found), find(doc), find(doc) == doc) for doc, found in sets if doc is not None)


def answers(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect() if r.doc_id is not None)


def test_components_of_odd_tables(spark):
    rows = cases.odd_rows()
    found = dedup.near_copies(cases.table(spark, rows), k=3, percent=85)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert answers(found) == expected(rows, 3, 85)
    nameless = [r for r in found.collect() if r.doc_id is None]
    assert len(nameless) == 2 and all(r.kept and r.component_id is None for r in nameless)


def test_links_that_centres_do_not_show(spark):
    """Chains: neighbours are alike, the ends are not, so most links are between members that are no centre."""
    r = random.Random(5)
    base = cases.sentence(r, 150, 9000).split()
    rows = []
    for chain in range(4):
        words = [w if i % 4 else f"c{chain}x{i}" for i, w in enumerate(base)]
        for step in range(12):
            words[step * 11 % 150] = f"s{chain}y{step}"
            rows.append((100 * step + chain, " ".join(words), "en", "s", 0))
    rows += [(5000 + i, " ".join(w if r.random() > 0.05 else f"e{r.randrange(9)}" for w in base), "en", "s", 0) for i in range(80)]
    r.shuffle(rows)
    assert answers(dedup.near_copies(cases.table(spark, rows), k=3, percent=85)) == expected(rows, 3, 85)


def test_documents_that_stay(spark):
    rows = cases.odd_rows()
    docs = cases.table(spark, rows)
    kept = dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    stay = {doc for doc, _, _, kept in expected(rows, 5, 80) if kept}
    assert {r.doc_id for r in kept.collect()} - {None} == stay


def test_empty_table(spark):
    assert dedup.near_copies(cases.empty(spark)).collect() == []
    assert dedup.drop_near_copies(cases.empty(spark)).collect() == []


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(200, j) for j in range(201, 260)] + [(300, 300), (None, 4), (5, None), (301, 302), (302, 301)]
    r.shuffle(edges)
    found = {x.node: x.root for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {j: 200 for j in range(201, 260)} | {302: 301}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
