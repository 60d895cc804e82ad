"""Queries over operators that are column functions only: host rules, licences, mixing, fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hosts, licenses, mixing, sketches

#: The address rules of the page query.
PAGE_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def page_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """url, n, bad: the labels of the document a page's address names by number."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("url")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    told = labels.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(bad, 1).otherwise(0)).alias("bad")
    )
    number = F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]+)', 1), '') as bigint)")
    numbered = pages.withColumn("path", hosts.path_of(F.col("url"))).withColumn("doc_id", number)
    return numbered.where(F.col("doc_id").isNotNull()).join(told, "doc_id").select("url", "n", "bad")


def op9_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    judged = hosts.judge_pages(pages, page_outcomes(spark, folder), PAGE_RULES)
    return judged.withColumn("floor", F.round("floor", 6)).drop("badness")


def op10_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return licenses.find_licenses(docs).withColumn("licenses", F.array_join("licenses", ","))


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mixing.mix(docs, keep=("doc_id", "source"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    told = sketches.edited_fingerprints(docs, lambda edited: F.sha2(edited.cast("binary"), 256))
    return told.withColumnRenamed("edited", "edited_sha256")


def _host_sql() -> str:
    def level(name: str, table: str) -> str:
        return f"""
    SELECT 1 / least(greatest(coalesce(CASE WHEN sum(n * (n - 1) * m * (1 - m)) > 0 THEN
             sum((bad - n * m) * (bad - n * m) - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)) END, CAST(0.5 AS DOUBLE)),
             CAST(0.001 AS DOUBLE)), CAST(0.5 AS DOUBLE)) - 1 AS {name} FROM {table}"""

    fits = []
    for action, rule in PAGE_RULES:
        host, path = hosts.split_rule(rule)
        fits.append(
            f"SELECT '{rule}' AS rule, '{action}' AS action, '{host}' AS rule_host, '{path}' AS rule_path"
        )
    return f"""
WITH parts AS (
    SELECT page_id, url,
           coalesce(translate(CASE WHEN instr(url, '://') > 0
             THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*', 0) END,
             '{hosts.UPPER}', '{hosts.LOWER}'), '') AS host,
           coalesce(CASE WHEN instr(url, '://') > 0
             THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END, '') AS path
    FROM pages),
told AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
         FROM labels GROUP BY doc_id),
outcomes AS (
    SELECT host, n, bad FROM parts
    JOIN told ON told.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]+)', 1), '') AS BIGINT)),
hosts0 AS (
    SELECT host, sum(n) AS n, sum(bad) AS bad FROM (SELECT host, n, bad FROM outcomes UNION ALL SELECT host, 0, 0 FROM parts)
    GROUP BY host),
hosts AS (SELECT *, regexp_extract(host, '([^.]*\\.)?[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix FROM hosts0),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad,
                    CAST((sum(sum(bad)) OVER () + 0.5) AS DOUBLE) / CAST((sum(sum(n)) OVER () + 1) AS DOUBLE) AS m
             FROM domains GROUP BY suffix),
s1 AS ({level("s", "suffixes")}),
suffix_means AS (SELECT suffix, (bad + m * s) / (n + s) AS m FROM suffixes, s1),
domains1 AS (SELECT d.domain, d.n, d.bad, m FROM domains d JOIN suffix_means USING (suffix)),
s2 AS ({level("s", "domains1")}),
domain_means AS (SELECT domain, (bad + m * s) / (n + s) AS m FROM domains1, s2),
hosts1 AS (SELECT h.host, h.n, h.bad, m FROM hosts h JOIN domain_means USING (domain)),
s3 AS ({level("s", "hosts1")}),
means AS (SELECT host, n, bad, (bad + m * s) / (n + s) AS badness, n + s AS sure FROM hosts1, s3),
known AS (SELECT *, badness - 1.645 * sqrt(badness * (1 - badness) / (sure + 1)) AS floor FROM means),
rules AS ({" UNION ALL ".join(fits)}),
best AS (
    SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
    FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path)
SELECT page_id, p.host, p.path, rule,
       coalesce(action, CASE WHEN floor > 0.3 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(n AS BIGINT) AS n_labelled, CAST(bad AS BIGINT) AS n_bad, round(floor, 6) AS floor
FROM parts p JOIN known k ON k.host = p.host LEFT JOIN best b ON b.host = p.host AND b.path = p.path
"""


def _license_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    pairs = ", ".join(f"{quote(k)}: {quote(v)}" for k, v in licenses.SENTENCES.items())
    known = ", ".join(quote(k) for k in licenses.SENTENCES)
    steps, names = ["s0 AS (SELECT doc_id, n_recognised, sequence, sequence AS rest, CAST([] AS VARCHAR[]) AS names FROM found)"], "s0"
    for i, (name, ids) in enumerate(licenses.RULES, 1):
        rule = quote("".join(f"<{each}>" for each in ids))
        steps.append(
            f"s{i} AS (SELECT doc_id, n_recognised, sequence, replace(rest, {rule}, '|') AS rest, "
            f"CASE WHEN contains(rest, {rule}) THEN list_append(names, {quote(name)}) ELSE names END AS names FROM s{i - 1})"
        )
        names = f"s{i}"
    return f"""
WITH plain AS (
    SELECT doc_id, string_split(regexp_replace(regexp_replace(lower(text), '[.!?:;][ \\t\\r\\n]+', chr(10), 'g'),
                                               '[^a-z0-9\\n]+', ' ', 'g'), chr(10)) AS parts FROM documents),
ids AS (
    SELECT doc_id, [MAP {{{pairs}}}[s] FOR s IN [trim(x) FOR x IN coalesce(parts, [])] IF s IN ({known})] AS ids FROM plain),
found AS (
    SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_recognised,
           coalesce(array_to_string(['<' || i || '>' FOR i IN ids], ''), '') AS sequence FROM ids),
{", ".join(steps)}
SELECT doc_id, n_recognised, sequence, coalesce(array_to_string(list_sort(list_distinct(names)), ','), '') AS licenses FROM {names}
"""


QUERIES = {
    "op7_source_mix": op7_source_mix,
    "op8_fingerprints": op8_fingerprints,
    "op9_host_reputation": op9_host_reputation,
    "op10_license_rules": op10_license_rules,
}
ORACLES = {"op9_host_reputation": _host_sql(), "op10_license_rules": _license_sql()}
