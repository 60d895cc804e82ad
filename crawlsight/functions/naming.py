"""Names of sources: slugs, module rules, path checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Requirements that only a browser transport can meet.
BROWSER_REQUIREMENTS = ("FF_ALIKE", "CHROME_ALIKE", "JS_EVAL")
# Module path parts that mark test code.
TEST_PARTS = ("test", "tests", "conftest")
TEST_PREFIX = "test_"


def class_part(path: Column) -> Column:
    """Last dotted name after the last colon."""
    return F.substring_index(F.substring_index(path, ":", -1), ".", -1)


def source_slug(path: Column) -> Column:
    """Snake-case name of a source class, without its ``Scraper`` ending.

    One pass marks both kinds of word border: lower case or digit before upper
    case, and the last capital of an acronym before a capitalised word.
    """
    stem = F.regexp_replace(class_part(path), "Scraper$", "")
    words = F.regexp_replace(stem, "([a-z0-9])(?=[A-Z])|([A-Z])(?=[A-Z][a-z])", "$1$2_")
    return F.lower(F.btrim(F.regexp_replace(words, "_+", "_"), F.lit("_")))


def is_test_module(module: Column) -> Column:
    return F.exists(
        F.split(module, r"\."),
        lambda part: part.isin(*TEST_PARTS) | part.startswith(TEST_PREFIX),
    )


def path_is_valid(path: Column) -> Column:
    """True where ``module:Class`` has something after its first colon."""
    colon = F.instr(path, ":")
    return F.coalesce((colon > 0) & (F.length(path) > colon), F.lit(False))


def needs_browser(requirements: Column) -> Column:
    """True where the requirements meet the browser set; captcha handlers count too."""
    wanted = F.array(*[F.lit(name) for name in BROWSER_REQUIREMENTS])
    captcha = F.exists(requirements, lambda each: F.lower(each).contains("captcha"))
    return F.coalesce(F.arrays_overlap(requirements, wanted) | captcha, F.lit(False))


def court_tags(court_ids: Column) -> Column:
    tags = F.transform(F.array_sort(court_ids), lambda court: F.concat(F.lit("court:"), court))
    return F.coalesce(tags, F.array().cast("array<string>"))
