"""Catalogue of crawl sources: discovery, routing, tags, deployments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naming

# The two worker pools.
BROWSER_POOL = "browser-pool"
HTTP_POOL = "scraper-pool"
SOURCE_CONCURRENCY = 1  # Fixed value: concurrent runs per source.


def source_discovery(catalogue: DataFrame) -> DataFrame:
    """Paths of the classes that are defined where they were found, tests left out."""
    own = F.col("defined_in") == F.col("module")
    return (
        catalogue.where(own & ~naming.is_test_module(F.col("module")))
        .select(F.concat("module", F.lit(":"), "class_name").alias("path"))
        .distinct()
        .orderBy("path")
    )


def source_paths_checked(paths: DataFrame, path: str = "path") -> DataFrame:
    return paths.withColumn("is_valid_path", naming.path_is_valid(F.col(path)))


def source_slugs(sources: DataFrame) -> DataFrame:
    return sources.withColumn("slug", naming.source_slug(F.col("path")))


def source_routing(sources: DataFrame) -> DataFrame:
    browser = naming.needs_browser(F.col("requirements"))
    return sources.withColumn("pool", F.when(browser, BROWSER_POOL).otherwise(HTTP_POOL)).withColumn(
        "transport", F.when(browser, "browser").otherwise("http")
    )


def courts_index(sources: DataFrame) -> DataFrame:
    """(court, source) pairs; a source without courts stands under a NULL court.

    Pairs and not lists: a court that most sources cover stays spread over tasks.
    """
    return sources.select(F.explode_outer("court_ids").alias("court"), "path").distinct()


def deployment_rows(
    sources: DataFrame, base_tags: tuple[str, ...], limit: int = SOURCE_CONCURRENCY
) -> DataFrame:
    """One deployment per source; its slug names the queue and the deployment alike."""
    tags = F.concat(
        F.array(*[F.lit(tag) for tag in base_tags], F.col("transport")),
        naming.court_tags(F.col("court_ids")),
    )
    parameters = F.to_json(
        F.struct(F.col("path").alias("scraper_path"), F.col("slug").alias("scraper_schema"))
    )
    return source_routing(source_slugs(sources)).select(
        "path",
        "slug",
        "pool",
        F.col("slug").alias("queue"),
        F.lit(limit).alias("concurrency_limit"),
        tags.alias("tags"),
        parameters.alias("parameters"),
    )


def slug_collisions(sources: DataFrame) -> DataFrame:
    """Slugs that more than one source maps to."""
    return (
        source_slugs(sources.select("path").distinct())
        .groupBy("slug")
        .agg(F.count("*").alias("sources"), F.min("path").alias("first_path"), F.max("path").alias("last_path"))
        .where(F.col("sources") > 1)
    )


def params_check(submissions: DataFrame) -> DataFrame:
    """Both run parameters must be there and non-empty; ``reason`` is NULL for good rows."""

    def absent(name: str):
        return F.coalesce(F.col(name), F.lit("")) == ""

    reason = (
        F.when(absent("scraper_path"), "scraper_path is required")
        .when(absent("scraper_schema"), "scraper_schema is required")
        .when(~naming.path_is_valid(F.col("scraper_path")), "scraper_path has no class")
    )
    return submissions.withColumn("reason", reason)
