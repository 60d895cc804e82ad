"""Labels and markdown cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of the report.
UNKNOWN = "(unknown)"
NO_REQUESTS = "_No requests recorded._"
NO_RESULTS = "_No results recorded._"
NO_ERRORS = "_No errors recorded._"


def label(value: Column) -> Column:
    """Text of a pivot key; a missing key gets its own label."""
    return F.coalesce(value.cast("string"), F.lit(UNKNOWN))


def or_none(value: Column) -> Column:
    """Text of a report field that is printed even when it is missing."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def error_text_clean(message: Column) -> Column:
    """An error message that fits into one markdown table cell."""
    escaped = F.replace(F.coalesce(message, F.lit("")), F.lit("|"), F.lit("\\|"))
    return F.replace(escaped, F.lit("\n"), F.lit(" "))


def cells(*values: Column) -> Column:
    """One markdown table line; values must not be NULL."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *values), F.lit(" |"))


def bold(value: Column) -> Column:
    return F.concat(F.lit("**"), value.cast("string"), F.lit("**"))
