"""The end of a crawl run: check its tables, archive them, verify the copy, report."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import optional_table, publish_runs, read_runs, write_reports
from .archive import archive_once, archive_verify, integrity_check, require_none
from .runs import run_report

MANIFEST = "schema string, run_id string, uri string"


def archived_runs(spark: SparkSession, root: str) -> DataFrame:
    return optional_table(spark, f"{root}/manifest", MANIFEST)


def archive_finished(
    runs: DataFrame, requests: DataFrame, results: DataFrame, errors: DataFrame, root: str
) -> DataFrame:
    """Archive all finished runs that are not archived yet; returns the verification.

    Drained runs wait for their resume. Unsound tables stop everything before a
    file is written. A run enters the manifest only after the rows of all its
    tables were counted back, so a broken attempt is simply done again.
    """
    spark = runs.sparkSession
    # Written first: what is archived and what enters the manifest are the same runs, whatever ``runs`` says later.
    attempt = f"{root}/attempts/{uuid.uuid4().hex}"
    archive_once(
        runs.where(~F.col("drained")).select("schema", "run_id", "uri"), archived_runs(spark, root)
    ).write.parquet(f"{attempt}/due")
    due = spark.read.schema(MANIFEST).parquet(f"{attempt}/due")
    tables = {"requests": requests, "results": results, "errors": errors}
    keys = due.select("schema", "run_id")
    mine = {name: table.join(keys, "run_id") for name, table in tables.items()}
    issues = integrity_check(*mine.values()).where(F.col("issue") != "error without its request")
    require_none(issues, "integrity check failed", f"{attempt}/issues")
    checks = None
    for name, table in mine.items():
        publish_runs(table, f"{root}/{name}")
        archive = read_runs(spark, f"{root}/{name}", table.schema)
        stored = archive.join(keys, ["schema", "run_id"], "left_semi")
        each = archive_verify(_row_counts(table, name), _row_counts(stored, name))
        checks = each if checks is None else checks.unionByName(each)
    require_none(checks.where(F.col("status") != "ok"), "archive could not be verified", f"{attempt}/unverified")
    reports = run_report(runs.join(keys, ["schema", "run_id"], "left_semi"), *tables.values())
    write_reports(reports, f"{root}/reports")
    due.write.mode("append").parquet(f"{root}/manifest")
    return checks


def _row_counts(table: DataFrame, name: str) -> DataFrame:
    """Rows per archived run, under the path of its folder."""
    path = F.concat_ws("/", F.lit(name), "schema", "run_id").alias("path")
    return table.groupBy(path).agg(F.count("*").alias("size"))
