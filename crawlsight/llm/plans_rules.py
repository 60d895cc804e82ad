"""The query of weak quality rules and its SQL check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import weak_rules as W

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ROUNDS = 30


def op11_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = W.judge(spark.read.parquet(f"{folder}/documents.parquet"), rounds=ROUNDS)
    blamed = F.size(F.filter("votes", lambda v: v < 0)).cast("long").alias("n_bad_votes")
    return judged.select("doc_id", *BASE, "base_failed", "kept", blamed)


def _sql() -> str:
    rules = range(len(W.RULES))
    words = "regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')"
    lines = "list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))"
    known = ", ".join(f"'{w}'" for w in W.FUNCTION_WORDS)
    votes = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{i}" for i, r in enumerate(W.RULES))
    names = ", ".join(f"v{i}" for i in rules)
    odds = " + ".join(
        ["ln(prior / (1 - prior))", *(f"CASE v{i} WHEN 1 THEN ln(g{i} / (1 - b{i})) WHEN -1 THEN ln((1 - g{i}) / b{i}) ELSE 0 END" for i in rules)]
    )

    def share(i: int, vote: int, mass: str, start: float, least: float) -> str:
        hit, voted = (f"coalesce(sum({mass}) FILTER (v{i} {test}), 0)" for test in (f"= {vote}", "<> 0"))
        return f"least(greatest(({hit} + {start * W.SEEN}) / ({voted} + {W.SEEN}), {W.LEAST_ON_GOOD if vote > 0 else W.LEAST_ON_BAD}), {W.SUREST})"

    start = ", ".join([f"CAST({W.PRIOR} AS DOUBLE) AS prior", *(f"CAST({x} AS DOUBLE) AS {s}{i}" for s, x in (("g", W.RIGHT_ON_GOOD), ("b", W.RIGHT_ON_BAD)) for i in rules)])
    step = ", ".join(
        [
            "least(greatest((sum(q) + 1) / (sum(n) + 2), 0.01), 0.99)",
            *(share(i, 1, "q", W.RIGHT_ON_GOOD, W.LEAST_ON_GOOD) for i in rules),
            *(share(i, -1, "n - q", W.RIGHT_ON_BAD, W.LEAST_ON_BAD) for i in rules),
        ]
    )
    return f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS MATERIALIZED (SELECT r, doc_id, t, {words} AS w, {lines} AS l FROM texts),
places AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM parts),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM places),
again AS (SELECT r, count(DISTINCT i + j) AS n FROM windows, (VALUES (0), (1), (2)) AS o(j) WHERE times > 1 GROUP BY r),
measures AS MATERIALIZED (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(translate(t, '{W.SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           len(list_filter(w, lambda x: lower(x) IN ({known}))) AS n_function,
           length(t) - length(translate(t, '{W.CAPITALS}', '')) AS n_capitals,
           len(list_filter(w, lambda x: right(x, 1) IN ('.', '?', '!'))) AS n_ends
    FROM parts LEFT JOIN again USING (r)),
votes AS MATERIALIZED (SELECT *, {votes} FROM measures),
patterns AS MATERIALIZED (SELECT {names}, CAST(count(*) AS DOUBLE) AS n FROM votes GROUP BY ALL),
em AS (
    SELECT 0 AS k, {start}
    UNION ALL
    SELECT k + 1, {step} FROM (SELECT *, n / (1 + exp(-({odds}))) AS q FROM em, patterns WHERE k < {ROUNDS}) GROUP BY k),
fitted AS (SELECT * FROM em WHERE k = {ROUNDS}),
told AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1 / (1 + exp(-({odds}))) AS quality FROM votes, fitted)
SELECT doc_id, {", ".join(BASE)}, base_failed, NOT base_failed AND quality >= 0.5 AS kept,
       CAST({" + ".join(f"CAST(v{i} < 0 AS INTEGER)" for i in rules)} AS BIGINT) AS n_bad_votes
FROM told
"""


QUERIES = {"op11_weak_rules": op11_weak_rules}
ORACLES = {"op11_weak_rules": _sql()}
