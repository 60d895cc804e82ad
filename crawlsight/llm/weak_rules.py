"""Quality rules that vote or abstain; expectation maximisation weighs them by how often they are right.

1. Each text is measured in its own row: words, symbols, lines and three-word windows that come again.
2. A rule looks at the measures and votes 1 (good), -1 (bad) or 0 (no opinion).
3. Votes are counted per pattern: ``3 ** rules`` rows at most, whatever the number of documents. Expectation
   maximisation over this one row of patterns is a single expression. It finds the share of good documents and how
   often each rule, where it votes, is right on good and on bad ones.
4. A document stays if its votes make it more likely good than ``threshold``, in place of passing all rules.

Everything is a column expression.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir

# Frequent function words of the four languages.
FUNCTION_WORDS = (
    "the of and to in is that it was for on are as with be at by this from or an a not have they "
    "le la les de des du et un une est que qui dans pour pas sur au avec par en "
    "der die das und ist nicht von mit den dem ein eine zu im auf für sich auch es "
    "el los las y una por con para del se su lo como no al"
).split()
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = "[\\x20\\x09-\\x0D]+"


class Rule(NamedTuple):
    """``bad`` and ``good`` are SQL conditions over the measures; where neither is true the rule abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 20", "n_words BETWEEN 50 AND 100000"),
    Rule("word length", "word_chars < 2.5 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("symbols", "n_symbols > 0.15 * n_words", "n_symbols < 0.02 * n_words"),
    Rule("same lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0 AND n_lines > 3"),
    Rule("same windows", "n_repeat_words > 0.5 * n_words", "n_repeat_words < 0.2 * n_words"),
    Rule("function words", "n_words >= 20 AND n_function < 0.03 * n_words", "n_function > 0.08 * n_words"),
    Rule("capitals", "n_capitals > 0.4 * word_chars", "n_capitals < 0.15 * word_chars"),
    Rule("sentences", "n_words >= 50 AND (n_ends < 0.004 * n_words OR n_ends > 0.7 * n_words)", "n_ends BETWEEN 0.02 * n_words AND 0.4 * n_words"),
)
MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_function n_capitals n_ends".split()


def _without(column: str, characters: str) -> str:
    return f"(char_length({column}) - char_length(translate({column}, '{characters}', '')))"


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """One row per document: doc_id and MEASURES, all long.

    n_repeat_words counts the words in windows that the text holds twice or more; windows are told apart by 64-bit hashes.
    """
    quoted = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)
    places = ", ".join(f"words[i + {j}]" for j in range(window))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # One step to a projection: what a lambda function looks into is an array that is there.
    rows = rows.withColumn("words", F.filter(F.split("text", BLANK), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    rows = rows.withColumn("windows", F.expr(f"IF(size(words) < {window}, array(), transform(sequence(0, size(words) - {window}), i -> xxhash64({places})))"))
    twice = "size(array_distinct(windows)) < size(windows)"
    rows = rows.withColumn("sorted", F.expr(f"CASE WHEN {twice} THEN sort_array(transform(windows, (h, i) -> struct(h, i))) END"))
    again = "(i > 0 AND sorted[i - 1].h = x.h) OR (i + 1 < size(sorted) AND sorted[i + 1].h = x.h)"
    rows = rows.withColumn("again", F.expr(f"sort_array(transform(filter(sorted, (x, i) -> {again}), x -> x.i))"))
    covered = f"""coalesce(aggregate(again, struct(0 AS gone, 0 AS n),
        (s, i) -> struct(i + {window} AS gone, s.n + i + {window} - greatest(i, s.gone) AS n), s -> s.n), 0)"""
    told = {
        "n_words": "size(words)",
        "word_chars": "char_length(array_join(words, ''))",
        "n_symbols": _without("text", SYMBOLS),
        "n_lines": "size(lines)",
        "n_dup_lines": "size(lines) - size(array_distinct(lines))",
        "n_repeat_words": covered,
        "n_function": f"size(filter(words, w -> lower(w) IN ({quoted})))",
        "n_capitals": _without("text", CAPITALS),
        "n_ends": "size(filter(words, w -> endswith(w, '.') OR endswith(w, '?') OR endswith(w, '!')))",
    }
    return rows.select("doc_id", *(F.expr(told[name]).cast("long").alias(name) for name in MEASURES))


def _vote(rule: Rule) -> str:
    return f"CASE WHEN {rule.bad} THEN -1 WHEN {rule.good} THEN 1 ELSE 0 END"


def _odds(votes: str, model: str, n_rules: int) -> str:
    """SQL of the logarithm of good against bad, for a pattern of votes."""
    each = [f"CASE {votes}[{r}] WHEN 1 THEN ln({model}.g[{r}] / (1 - {model}.b[{r}])) WHEN -1 THEN ln((1 - {model}.g[{r}]) / {model}.b[{r}]) ELSE 0D END" for r in range(n_rules)]
    return " + ".join([f"ln({model}.prior / (1 - {model}.prior))", *each])


#: At the start: the share of good documents; how often a rule that votes is right on good and on bad ones (most rules see
#: one kind of badness and approve of the others); as many votes it counts as having cast so.
PRIOR, RIGHT_ON_GOOD, RIGHT_ON_BAD, SEEN = 0.8, 0.95, 0.4, 2.0
#: A rule is never taken to be surer than this, nor to blame good documents as often as bad ones.
SUREST, LEAST_ON_GOOD, LEAST_ON_BAD = 0.99, 0.8, 0.25


def model(patterns: DataFrame, n_rules: int, rounds: int = 30) -> DataFrame:
    """One row of one struct: prior, g (right on good documents, by rule), b (right on bad ones).

    ``patterns`` has votes and n. All patterns meet in one row: 3 ** n_rules of them at most.
    """
    q = f"transform(p, x -> struct(x.votes AS votes, x.n AS n, x.n / (1 + exp(-({_odds('x.votes', 'm', n_rules)}))) AS q))"

    def share(vote: int, mass: str, start: float, least: float) -> str:
        hit = f"aggregate(qs, 0D, (s, x) -> s + IF(x.votes[r] = {vote}, {mass}, 0D))"
        voted = f"aggregate(qs, 0D, (s, x) -> s + IF(x.votes[r] = 0, 0D, {mass}))"
        return f"least(greatest(({hit} + {start * SEEN}D) / ({voted} + {SEEN}D), {least}D), {SUREST}D)"

    every = f"sequence(0, {n_rules - 1})"
    prior = "(aggregate(qs, 0D, (s, x) -> s + x.q) + 1) / (aggregate(qs, 0D, (s, x) -> s + x.n) + 2)"
    fitted = f"""struct(least(greatest({prior}, 0.01D), 0.99D) AS prior,
        transform({every}, r -> {share(1, "x.q", RIGHT_ON_GOOD, LEAST_ON_GOOD)}) AS g,
        transform({every}, r -> {share(-1, "x.n - x.q", RIGHT_ON_BAD, LEAST_ON_BAD)}) AS b)"""
    start = f"struct({PRIOR}D AS prior, array_repeat({RIGHT_ON_GOOD}D, {n_rules}) AS g, array_repeat({RIGHT_ON_BAD}D, {n_rules}) AS b)"
    gathered = patterns.agg(F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("p"))
    return gathered.select(F.expr(f"aggregate(sequence(1, {rounds}), {start}, (m, k) -> element_at(transform(array({q}), qs -> {fitted}), 1))").alias("m"))


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    threshold: float = 0.5,
    rounds: int = 30,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, MEASURES, votes (by rule), base_failed, quality, kept.

    ``base_failed``: fewer than 50 words, or more than half of the words in windows that come again. ``quality`` is
    the posterior probability that a document with these votes is good; ``kept`` is ``quality >= threshold``, and
    false if the base failed.

    A NULL text is an empty one: it has no words, and fails. NULL ids stay, repeated rows are each counted and judged.
    Equal votes give equal quality. Long texts are measured whole. An empty table gives no rows. Other columns do not matter.
    The measures are written to the shared folder, so texts are read once.
    """
    spark = docs.sparkSession
    folder = fresh_dir(spark, "weak-rules")
    votes = F.expr(f"array({', '.join(map(_vote, rules))})").alias("votes")
    measured(docs, doc_id, text).select("*", votes).write.parquet(folder)
    rows = spark.read.parquet(folder)
    fitted = model(rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), len(rules), rounds)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    quality = F.expr(f"1 / (1 + exp(-({_odds('votes', 'm', len(rules))})))")
    rows = rows.withColumn("m", fitted.scalar()).select("doc_id", *MEASURES, "votes", failed.alias("base_failed"), quality.alias("quality"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
