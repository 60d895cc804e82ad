"""Archiving finished runs, twice and after a broken input."""

import pytest

import __spark_entry__ as contract
from crawlsight.operators import finish
from crawlsight.plans import archive as archive_plans
from crawlsight.sources import schemas
from crawlsight.sources.tables import publish_runs, read_json, read_runs
from tests.test_runs import at


def tables(spark, status="completed"):
    runs = spark.createDataFrame(
        [("a", "m:A", "s", "u/a", False), ("b", "m:B", "s", "u/b", False), ("d", "m:D", "s", "u/d", True)],
        schemas.RUNS,
    )
    requests = spark.createDataFrame(
        [(r, i, "list", status, at(i)) for r in "abd" for i in range(3)], schemas.REQUESTS
    )
    results = spark.createDataFrame([("a", 1, "case", 1)], schemas.RESULTS)
    errors = spark.createDataFrame(
        [("a", 1, 1, "http", "E", "m", "u"), ("a", 2, 77, "http", "E", "m", "u")], schemas.ERRORS
    )
    return runs, requests, results, errors


def test_archive_finished_runs_once(spark, tmp_path):
    root = str(tmp_path / "archive")
    finish.archive_finished(*tables(spark), root)
    assert sorted(r.run_id for r in finish.archived_runs(spark, root).collect()) == ["a", "b"]
    stored = spark.read.parquet(f"{root}/requests")
    assert {(r.run_id, r["count"]) for r in stored.groupBy("run_id").count().collect()} == {("a", 3), ("b", 3)}
    report = (tmp_path / "archive" / "reports" / "run_id=a").glob("*.txt")
    text = "".join(f.read_text() for f in report)
    assert text.startswith("# Scrape completed with errors\n") and text.endswith("|\n")
    finish.archive_finished(*tables(spark), root)
    assert finish.archived_runs(spark, root).count() == 2
    assert spark.read.parquet(f"{root}/requests").count() == 6


def test_unsound_tables_are_not_archived(spark, tmp_path):
    root = str(tmp_path / "archive")
    with pytest.raises(RuntimeError, match="unknown request status"):
        finish.archive_finished(*tables(spark, status="odd"), root)
    assert finish.archived_runs(spark, root).count() == 0


def test_json_export(spark, tmp_path):
    path = tmp_path / "errors.json"
    path.write_text('{"run_id":"r","id":1,"message":"x"}\n')
    assert read_json(spark, str(path), schemas.ERRORS).first().message == "x"


def test_published_runs_share_folders_and_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "archive")
    # Ids that look like numbers, empty ones and none at all stay what they are.
    rows = [("s", name, i) for name in [None, "", "007", *(f"r{k}" for k in range(300))] for i in range(2)]
    schema = "schema string, run_id string, id long"
    table = spark.createDataFrame(rows, schema)
    stored = lambda: sorted(map(tuple, read_runs(spark, path, schema).collect()), key=str)
    folders = lambda: {d.name for d in (tmp_path / "archive").glob("folder=*")}
    publish_runs(table, path)
    first = folders()
    assert stored() == sorted(rows, key=str) and len(first) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    publish_runs(table, path)
    assert stored() == sorted(rows, key=str) and folders() == first
    changed = [("s", None, 7), ("s", "r5", 8), ("s", "new", 9)]
    publish_runs(spark.createDataFrame(changed, schema), path)
    kept = [r for r in rows if r[1] not in (None, "r5")]
    assert stored() == sorted(kept + changed, key=str) and len(folders()) == len(first) + 1
    publish_runs(table.limit(0), str(tmp_path / "none"))
    publish_runs(table.limit(3), str(tmp_path / "none"))
    assert read_runs(spark, str(tmp_path / "none"), schema).count() == 3


def test_the_archive_has_no_folder_per_run(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(archive_plans, "fresh_dir", lambda spark, name: str(tmp_path / name))
    found = contract.queries()["archive_write"](spark, small)
    files = list((tmp_path / "archive-requests").rglob("*.parquet"))
    assert found.count() > len({f.parent for f in files}) > 0
    assert len({f.parent for f in files}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
