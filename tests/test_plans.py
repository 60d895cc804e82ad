"""Physical plans: no pairs of rows, no Python, shared shuffles, early limits."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from crawlsight.plans import catalog
from crawlsight.sources.tables import write_runs

SINKS = {"progress_stream", "telemetry_stream", "telemetry_stream_sketch", "trigger_stream", "trigger_stream_proactive", "trigger_stream_compound", "trigger_stream_sequence", "archive_stream", "archive_verify_listing", "archive_write"}


def plan(frame, run=False):
    if run:
        frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in SINKS])
def test_no_pairing_and_no_python(spark, small, name):
    text = plan(contract.queries()[name](spark, small))
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)


@pytest.mark.parametrize(
    "name", ["metric_histograms", "setting_compare", "trigger_reactive", "trigger_compound", "trigger_sequence", "trigger_metric"]
)
def test_both_sides_of_a_scan_share_their_shuffle(spark, small, name):
    text = plan(contract.queries()[name](spark, small), run=True)
    assert "ReusedExchange" in text and text.count("FileScan") == 1


def test_ranks_are_cut_before_the_shuffle(spark, small):
    text = plan(contract.queries()["errors_detail_topk"](spark, small))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_only_needed_columns_are_read(spark, small):
    text = plan(contract.queries()["requests_by_status"](spark, small))
    assert "props" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    text = plan(contract.queries()["errors_by_type"](spark, small))
    assert "PushedFilters: [Or(" in text
    text = plan(contract.queries()["downloads_needed"](spark, small))
    # The candidates are read without their content.
    assert any("text" not in cols for cols in re.findall(r"ReadSchema: struct<([^>]*)>", text))


def test_a_huge_run_becomes_several_files(spark, tmp_path):
    rows = spark.range(0, 400_000, numPartitions=8).select(
        F.lit("s").alias("schema"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("r"), F.col("id") % 30)).otherwise("hot").alias("run_id"),
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "2m")
    try:
        write_runs(rows, str(tmp_path / "out"))
    finally:
        spark.conf.unset(advisory)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "out" / "schema=s").iterdir()}
    assert files["run_id=hot"] > 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400_000


def test_rates_are_rounded_before_quiet_intervals_are_made(spark, small):
    text = plan(contract.queries()["progress_windows"](spark, small))
    # A plan is written from its end: what is below the last Generate runs before it.
    assert text.rindex("Generate") < text.index("round(")


def test_the_stream_of_snapshots_rounds_before_quiet_intervals_are_made(spark, small):
    text = plan(contract.queries()["progress_stream"](spark, small))
    assert text.rindex("Generate") < text.index("round(")
