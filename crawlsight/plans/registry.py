"""Registration of queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import apply_settings
from ..sources.derive import derive, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Access to the tables of one data folder by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __call__(self, *names: str):
        tables = [derive(self.spark, self.folder, name) for name in names]
        return tables[0] if len(tables) == 1 else tables


def comparable(result: DataFrame) -> DataFrame:
    """Timestamps without zone, as the checking database has them."""
    return result.select(
        *[
            F.col(f"`{field.name}`").cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(f"`{field.name}`")
            for field in result.schema.fields
        ]
    )


def query(name: str, tables: tuple[str, ...] = (), sql: str | None = None):
    """Register a plan; ``sql`` sees the derived ``tables`` by name."""

    def register(plan: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_settings(spark)
            return comparable(plan(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = combine(tables, sql)
        return plan

    return register


def combine(tables: tuple[str, ...], sql: str) -> str:
    """Put the derived tables in front of a check that may have CTEs of its own."""
    head = with_sql(*tables) if tables else ""
    body = sql.strip()
    if head.strip() == "WITH":
        head = ""
    if head and body.upper().startswith("WITH "):
        return head.rstrip() + ",\n" + body[5:]
    return head + body
