"""Run analytics on small hand tables."""

import datetime as dt

import pytest

from crawlsight.operators import progress, runs
from crawlsight.sources import schemas
from crawlsight.sources.tables import list_objects, optional_table, write_runs


def at(second):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)


@pytest.fixture(scope="module")
def t(spark):
    class Hand:
        runs = spark.createDataFrame(
            [
                ("a", "m:AScraper", "a", "s3://x/a.db", False),
                ("empty", "m:EScraper", "e", "s3://x/e.db", False),
                ("drained", "m:DScraper", "d", "s3://x/d.db", True),
            ],
            schemas.RUNS,
        )
        requests = spark.createDataFrame(
            [
                ("a", 1, "list", "completed", at(0)),
                ("a", 2, "list", "completed", at(30)),
                ("a", 3, None, "failed", at(310)),
                ("a", 4, "(unknown)", "odd", at(320)),
                ("drained", 5, "list", "pending", at(0)),
            ],
            schemas.REQUESTS,
        )
        results = spark.createDataFrame(
            [("a", 1, "case", None), ("a", 2, "case", None), ("a", 3, "doc", 1), ("a", 4, "doc", 0), ("a", 5, "doc", None)],
            schemas.RESULTS,
        )
        errors = spark.createDataFrame(
            [
                ("a", 1, 1, "http", "E", "x|y\nz", "u1"),
                ("a", 2, 99, "http", "E", None, "u2"),
                ("a", 3, None, "late", "E", "m", None),
                ("a", 4, 3, "http", "E", "m", "u4"),
            ],
            schemas.ERRORS,
        )

    return Hand


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*(order or frame.columns)).collect()]


def test_missing_flags_count_as_invalid(t):
    assert rows(runs.results_by_type(t.results)) == [("a", "case", None, 2), ("a", "doc", 1, 2)]
    assert rows(runs.results_table_rows(t.results), "is_total", "result_type") == [
        ("a", "case", 0, 0, 2, 2),
        ("a", "doc", 0, 1, 2, 3),
        ("a", None, 1, 1, 4, 5),
    ]


def test_orphans_and_missing_requests(t):
    found = rows(runs.errors_by_continuation(t.errors, t.requests), "continuation", "error_type")
    # Request 3 has no step, request 99 does not exist: all of them have no step.
    assert found == [("a", None, "http", 2), ("a", None, "late", 1), ("a", "list", "http", 1)]


def test_pivot_merges_unknown(t):
    found = rows(runs.pivot_counts(runs.requests_by_status(t.requests), "continuation", "status"))
    mine = [r for r in found if r[0] == "a"]
    assert ("a", "row_total", "(unknown)", None, 2) in mine
    assert ("a", "col_total", None, "completed", 2) in mine
    assert ("a", "grand_total", None, None, 4) in mine
    assert ("a", "cell", "(unknown)", "odd", 1) in mine


def test_pivot_markdown(t):
    found = dict(
        rows(
            runs.pivot_markdown(
                runs.requests_by_status(t.requests), "continuation", "status", "Continuation", "Status"
            ).select("run_id", "markdown")
        )
    )
    assert found["a"] == "\n".join(
        [
            "| Continuation \\ Status | completed | failed | odd | **Total** |",
            "| --- | --- | --- | --- | --- |",
            "| (unknown) |  | 1 | 1 | **2** |",
            "| list | 2 |  |  | **2** |",
            "| **Total** | **2** | **1** | **1** | **4** |",
        ]
    )


def test_totals_and_outcome(t):
    assert rows(runs.errors_total(t.errors, t.runs)) == [("a", 4), ("drained", 0), ("empty", 0)]
    assert rows(runs.run_outcome(t.runs, t.errors)) == [
        ("a", 4, "completed with errors"),
        ("empty", 0, "completed"),
    ]
    assert rows(runs.error_broadcast(t.errors)) == [("a", 4, "http=3, late=1")]


@pytest.mark.parametrize("n", [0, 50, 51])
def test_detail_limit(spark, n):
    errors = spark.createDataFrame(
        [("r", i, None, "t", "c", "m", "u") for i in range(n, 0, -1)], schemas.ERRORS
    )
    the_run = spark.createDataFrame([("r", "m:R", "r", "x", False)], schemas.RUNS)
    detail = runs.errors_detail_topk(errors)
    assert [r.id for r in detail.orderBy("rank").collect()] == list(range(1, min(n, 50) + 1))
    assert rows(runs.errors_truncation(errors, the_run)) == [("r", n, min(n, 50), max(n - 50, 0))]
    empty = spark.createDataFrame([], schemas.REQUESTS)
    none = spark.createDataFrame([], schemas.RESULTS)
    report = runs.run_report(the_run, empty, none, errors).first().report
    assert ("_…and 1 more (showing first 50)._" in report) == (n == 51)


def test_report_text(t):
    found = dict(rows(runs.run_report(t.runs, t.requests, t.results, t.errors)))
    assert set(found) == {"a", "empty"}
    assert found["empty"] == "\n".join(
        [
            "# Scrape completed",
            "",
            "- **Scraper**: `m:EScraper`",
            "- **Schema**: `e`",
            "- **Database**: `s3://x/e.db`",
            "- **Requests**: 0",
            "- **Results**: 0",
            "- **Errors**: 0",
            "",
            "## Requests by status and continuation",
            "",
            "_No requests recorded._",
            "",
            "## Results by type",
            "",
            "_No results recorded._",
            "",
            "## Errors by continuation and type",
            "",
            "_No errors recorded._",
            "",
        ]
    )
    a = found["a"]
    assert "| case | 0 | 2 | 2 |\n| doc | 1 | 2 | 3 |\n| **Total** | | | **5** |" in a
    assert "| http | E | x\\|y z | u1 |\n| http | E |  | u2 |\n| late | E | m | None |" in a


def test_summary_of_an_empty_run(t):
    found = {r.run_id: r for r in runs.run_summary(t.runs, t.requests, t.results, t.errors).collect()}
    empty = found["empty"]
    assert (empty.total, empty.rows, empty.by_type, empty.requests_by_status) == (0, [], {}, [])
    assert found["a"].by_type == {"http": 3, "late": 1}
    assert [r.message for r in found["a"].rows] == ["x|y\nz", None, "m", "m"]


def test_progress(t):
    snapshot = {r.run_id: r for r in progress.progress_snapshot(t.runs, t.requests, t.results, t.errors).collect()}
    a = snapshot["a"]
    assert (a.total, a.completed, a.pending, a.in_progress, a.failed) == (4, 2, 0, 0, 1)
    assert (a.results, a.valid, a.invalid, a.errors) == (5, 1, 4, 4)
    assert a.requests_per_minute == pytest.approx(4.0)
    assert snapshot["empty"].requests_per_minute is None and snapshot["empty"].total == 0
    windows = rows(progress.progress_windows(t.requests), "run_id", "snapshot_at")
    assert [(r[1], r[2], r[3], r[4]) for r in windows if r[0] == "a"] == [
        (at(300), 2, 2, 2),
        (at(600), 0, 4, 2),
    ]


def test_zero_span_has_no_throughput(spark):
    one = spark.createDataFrame([("r", 1, "s", "completed", at(0))], schemas.REQUESTS)
    assert progress.throughput_per_minute(one).first().requests_per_minute is None


def test_optional_table(spark, tmp_path):
    missing = optional_table(spark, str(tmp_path / "nope"), schemas.ERRORS)
    assert missing.count() == 0 and missing.columns[0] == "run_id"
    assert runs.errors_by_type(missing).count() == 0
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"this is no parquet file")
    with pytest.raises(Exception):
        optional_table(spark, str(bad), schemas.ERRORS).count()


def test_archive_is_idempotent_and_replaces_only_its_runs(spark, t, tmp_path):
    path = str(tmp_path / "archive")
    table = t.requests.join(t.runs.select("run_id", "schema"), "run_id")
    write_runs(table, path)
    write_runs(table, path)
    assert spark.read.parquet(path).count() == 5
    write_runs(table.where("run_id = 'a' AND id = 1"), path)
    counts = spark.read.parquet(path).groupBy("run_id").count()
    assert rows(counts) == [("a", 1), ("drained", 1)]
    listed = list_objects(spark, path).collect()
    assert listed and all(r.size > 0 for r in listed if r.path.endswith(".parquet"))
