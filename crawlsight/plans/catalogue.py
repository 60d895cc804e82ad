"""Catalogue queries over the derived sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import naming
from ..operators import catalogue
from .registry import query

# RE2 has no lookahead; the same borders are marked with groups, twice because matches overlap.
CLASS = "regexp_extract({path}, '([^.:]*)$', 1)"
_STEM = f"regexp_replace({CLASS}, 'Scraper$', '')"
_LOWER_UPPER = f"regexp_replace({_STEM}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
_ACRONYM = f"regexp_replace({_LOWER_UPPER}, '([A-Z])([A-Z][a-z])', '\\1_\\2', 'g')"
_TWICE = f"regexp_replace({_ACRONYM}, '([A-Z])([A-Z][a-z])', '\\1_\\2', 'g')"
SLUG = f"lower(trim(regexp_replace({_TWICE}, '_+', '_', 'g'), '_'))"
BROWSER = "coalesce(requirements_text LIKE '%FF_ALIKE%' OR requirements_text LIKE '%JS_EVAL%', false)"
POOL = f"CASE WHEN {BROWSER} THEN 'browser-pool' ELSE 'scraper-pool' END"
TRANSPORT = f"CASE WHEN {BROWSER} THEN 'browser' ELSE 'http' END"
BASE_TAGS = ("crawl", "source")


@query("source_slug", ("sources",), f"SELECT path, {SLUG.format(path='path')} AS slug FROM sources")
def _(t):
    return catalogue.source_slugs(t("sources")).select("path", "slug")


@query(
    "source_discovery",
    ("sources",),
    """SELECT DISTINCT module || ':' || class_name AS path FROM sources WHERE defined_in = module
AND NOT regexp_matches(module, '(^|\\.)(test|tests|conftest|test_[^.]*)(\\.|$)')""",
)
def _(t):
    return catalogue.source_discovery(t("sources"))


@query(
    "source_path_valid",
    ("submissions",),
    """SELECT submission, scraper_path, coalesce(regexp_matches(scraper_path, '^[^:]*:.'), false) AS is_valid_path
FROM submissions""",
)
def _(t):
    return catalogue.source_paths_checked(t("submissions"), "scraper_path").drop("scraper_schema")


@query(
    "court_tags",
    ("sources",),
    """SELECT path, coalesce((SELECT string_agg('court:' || court, ',' ORDER BY court)
    FROM unnest(string_split(courts_text, ',')) AS c(court) WHERE court <> ''), '') AS tags FROM sources""",
)
def _(t):
    tags = naming.court_tags(F.col("court_ids"))
    return t("sources").select("path", F.array_join(tags, ",").alias("tags"))


@query(
    "courts_index",
    ("sources",),
    """SELECT DISTINCT c.court, s.path FROM sources s, unnest(string_split(s.courts_text, ',')) AS c(court)
WHERE c.court <> ''
UNION ALL SELECT DISTINCT NULL, path FROM sources WHERE coalesce(courts_text, '') = ''""",
)
def _(t):
    return catalogue.courts_index(t("sources"))


@query(
    "source_routing",
    ("sources",),
    f"SELECT path, {POOL} AS pool, {TRANSPORT} AS transport FROM sources",
)
def _(t):
    return catalogue.source_routing(t("sources")).select("path", "pool", "transport")


@query(
    "deployment_rows",
    ("sources",),
    f"""SELECT path, {SLUG.format(path="path")} AS slug, {POOL} AS pool, {SLUG.format(path="path")} AS queue,
  1 AS concurrency_limit, 'crawl,source,' || {TRANSPORT} || coalesce((SELECT string_agg(',court:' || court, ''
    ORDER BY court) FROM unnest(string_split(courts_text, ',')) AS c(court) WHERE court <> ''), '') AS tags,
  '{{"scraper_path":"' || path || '","scraper_schema":"' || {SLUG.format(path="path")} || '"}}' AS parameters
FROM sources""",
)
def _(t):
    rows = catalogue.deployment_rows(t("sources"), BASE_TAGS)
    return rows.withColumn("tags", F.array_join("tags", ","))


@query(
    "slug_collisions",
    ("sources",),
    f"""SELECT slug, count(*) AS sources, min(path) AS first_path, max(path) AS last_path
FROM (SELECT DISTINCT path, {SLUG.format(path="path")} AS slug FROM sources) x
GROUP BY 1 HAVING count(*) > 1""",
)
def _(t):
    return catalogue.slug_collisions(t("sources"))


@query(
    "params_check",
    ("submissions",),
    """SELECT submission, scraper_path, scraper_schema,
  CASE WHEN coalesce(scraper_path, '') = '' THEN 'scraper_path is required'
    WHEN coalesce(scraper_schema, '') = '' THEN 'scraper_schema is required'
    WHEN NOT regexp_matches(scraper_path, '^[^:]*:.') THEN 'scraper_path has no class' END AS reason
FROM submissions""",
)
def _(t):
    return catalogue.params_check(t("submissions"))
