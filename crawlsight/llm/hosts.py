"""Host rules and empirical-Bayes host reputation.

A page is judged by the longest address rule that fits it, else by the reputation of its host.
Reputation is the share of bad outcomes among a host's labelled pages, shrunk step by step: the
suffix towards the whole, the registered domain towards its suffix, the host towards its domain.
How strongly is estimated from the data at each step (moments of the beta-binomial).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A correlation of outcomes within a group: never none, never total; where nothing tells, the most.
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 0.5


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#``; A-Z in lower case. NULL or no ``://``: empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``. NULL or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def split_rule(rule: str) -> tuple[str, str]:
    """A rule's host and path: ``example.org/es/`` is the host ``example.org`` and the path ``/es/``."""
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest of ``rules`` (action, host and path) that fits, as struct (length, rule, action), else NULL.

    The rules are part of the plan, by host; a page looks up its host and the domains above it.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for action, rule in rules:
        key, start = split_rule(rule)
        by_host.setdefault(key, []).append((start, rule, action))
    if not by_host:
        return F.lit(None).cast("struct<length:int,rule:string,action:string>")
    table = F.create_map(
        *[
            cell
            for key, found in by_host.items()
            for cell in (
                F.lit(key),
                F.array(
                    *[
                        F.struct(
                            F.lit(len(rule)).alias("length"),
                            F.lit(rule).alias("rule"),
                            F.lit(action).alias("action"),
                            F.lit(start).alias("start"),
                        )
                        for start, rule, action in found
                    ]
                ),
            )
        ]
    )
    labels = F.split(host, r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    known = F.filter(above, lambda name: name.isin(list(by_host)))
    fits = F.filter(
        F.flatten(F.transform(known, lambda name: table[name])), lambda rule: F.startswith(path, rule["start"])
    )
    best = F.array_max(fits)
    return F.struct(best["length"].alias("length"), best["rule"].alias("rule"), best["action"].alias("action"))


def _strength(groups: DataFrame) -> Column:
    """How many pages the prior of a level is worth. ``groups`` has n, bad and the prior mean m."""
    spread = F.col("m") * (1 - F.col("m"))
    extra = F.sum((F.col("bad") - F.col("n") * F.col("m")) ** 2 - F.col("n") * spread)
    room = F.sum(F.col("n") * (F.col("n") - 1) * spread)
    correlation = F.least(
        F.greatest(F.coalesce(F.when(room > 0, extra / room), F.lit(MOST_CORRELATION)), F.lit(LEAST_CORRELATION)),
        F.lit(MOST_CORRELATION),
    )
    return groups.agg((1 / correlation - 1).alias("strength")).scalar()


def _shrunk(groups: DataFrame, name: str) -> DataFrame:
    mean = (F.col("bad") + F.col("m") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return groups.withColumn("strength", _strength(groups)).withColumn(name, mean)


def host_reputation(pages: DataFrame, outcomes: DataFrame, deviations: float = 1.645) -> DataFrame:
    """Per host: n and bad (labelled pages, bad ones), badness (posterior mean) and floor (its lower bound).

    ``pages`` has host; ``outcomes`` has host, n, bad, any number of rows per host. A host without
    labelled pages gets its domain's mean. No outcome at all: the mean is one half everywhere, and
    the bound is far below it.
    ``floor`` lies ``deviations`` standard deviations of the posterior below its mean.
    """
    seen = pages.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    counted = seen.unionByName(outcomes.select("host", F.col("n").cast("long"), F.col("bad").cast("long")))
    hosts = (
        counted.groupBy("host")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .withColumn("domain", domain_of(F.col("host")))
        .withColumn("suffix", suffix_of(F.col("host")))
    )
    # One row per host; every level and its strength read them again.
    ensure_checkpoint_dir(pages.sparkSession)
    hosts = hosts.checkpoint()
    totals = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*totals)
    suffixes = domains.groupBy("suffix").agg(*totals)
    whole = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("m"))

    suffixes = suffixes.withColumn("m", whole.scalar())
    suffixes = _shrunk(suffixes, "mean").select("suffix", F.col("mean").alias("m"))
    domains = domains.join(suffixes, "suffix")
    domains = _shrunk(domains, "mean").select("domain", F.col("mean").alias("m"))
    hosts = hosts.join(domains, "domain")
    hosts = _shrunk(hosts, "badness")
    sure = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("badness") * (1 - F.col("badness")) / (sure + 1))
    return hosts.select("host", "n", "bad", "badness", (F.col("badness") - deviations * deviation).alias("floor"))


def judge_pages(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]],
    block_at: float = 0.3,
    deviations: float = 1.645,
    url: str = "url",
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """One row per page: ``keep``, host, path, rule, verdict (allow or block), n, bad, badness, floor.

    ``outcomes`` has url, n, bad: how often a page was labelled, and how often as bad. The fitting
    rule's action is the verdict. Without a rule a page is blocked if its host's share of bad pages
    is above ``block_at`` for sure, that is, if the lower posterior bound is. NULL or malformed
    addresses have empty host and path and are judged as one more host. Repeated rows are judged
    one by one; an empty table gives no rows; other columns do not matter.
    """
    parts = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    told = outcomes.select(host_of(F.col("url")).alias("host"), "n", "bad")
    known = host_reputation(parts, told, deviations)
    judged = parts.join(known, "host").withColumn("best", fitting_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("floor") > block_at, "block").otherwise("allow")
    return judged.select(
        *keep,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), method).alias("verdict"),
        F.col("n").alias("n_labelled"),
        F.col("bad").alias("n_bad"),
        "badness",
        "floor",
    )
