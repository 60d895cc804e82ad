"""Archive plan, upserts and checks on hand tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from crawlsight.operators import archive
from crawlsight.sources import schemas
from crawlsight.sources.tables import placed, read_stream
from crawlsight.streaming import archive as streaming
from crawlsight.streaming.drain import to_parquet


def downloads(spark, rows):
    return spark.createDataFrame(rows, schemas.DOWNLOADS)


@pytest.fixture(scope="module")
def first(spark):
    return downloads(
        spark,
        [
            ("p/", "http://h/a.pdf", "k1", None, "same", 1),
            ("p/", "http://h/b.pdf", "k2", None, "same", 2),
            ("p/", "http://h/c.txt", "k1", None, "same", 3),
            ("q/", "http://h/a.pdf", "k1", None, "same", 4),
            ("p/", "http://h/d.pdf", "", None, "other", 5),
            ("p/", "http://h/e.pdf", None, None, "other", 6),
        ],
    )


def test_objects(first):
    found = {r.content_key: r for r in archive.objects_of(first).collect()}
    # Equal bytes: two extensions and two prefixes make three objects.
    assert len(found) == 4
    assert sorted(r.first_seq for r in found.values()) == [1, 3, 4, 5]
    assert sorted(r["size"] for r in found.values()) == [4, 4, 4, 5]


def test_pointers_last_write_wins(first):
    found = {(r.prefix, r.file_url[-4:]) for r in archive.pointers_of(first).collect()}
    assert found == {("p/", ".txt"), ("p/", ".pdf"), ("q/", ".pdf")}
    assert archive.pointers_of(first).count() == 3


def test_plan(spark, first):
    asked = downloads(
        spark,
        [
            ("p/", "u1", "k1", None, "", 10),
            ("p/", "u2", "k9", None, "", 11),
            ("p/", "u3", "", None, "", 12),
            ("p/", "u4", None, None, "", 13),
            ("q/", "u5", "k2", None, "", 14),
        ],
    )
    pointers = archive.pointers_of(first)
    plan = {r.url: r for r in archive.download_plan(asked, pointers).collect()}
    assert [plan[u].download for u in ("u1", "u2", "u3", "u4", "u5")] == [False, True, True, True, True]
    assert plan["u1"].file_url.endswith(".txt")
    assert sorted(r.url for r in archive.downloads_needed(asked, pointers).collect()) == ["u2", "u3", "u4", "u5"]
    assert [r.url for r in archive.downloads_skipped(asked, pointers).collect()] == ["u1"]


def test_upserts_are_idempotent(spark, first):
    objects, pointers = archive.objects_of(first), archive.pointers_of(first)
    assert archive.content_upsert(first, objects).count() == 0
    again = archive.pointer_upsert(first, pointers)
    assert sorted(map(tuple, again.collect())) == sorted(
        map(tuple, pointers.select("prefix", "dedup_sha", "file_url").collect())
    )
    later = downloads(spark, [("p/", "http://h/z.gif", "k2", None, "new", 9)])
    changed = archive.pointer_upsert(later, pointers)
    assert changed.count() == 3 and changed.where("file_url LIKE '%.gif'").count() == 1


def test_bytes_to_write(first):
    empty = archive.objects_of(first).limit(0)
    found = archive.content_to_write(first, empty).collect()
    assert sorted((r.first_seq, r.content) for r in found) == [(1, "same"), (3, "same"), (4, "same"), (5, "other")]


def test_verify(spark):
    manifest = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "path string, size bigint")
    listing = spark.createDataFrame([("a", 1), ("b", 9), ("z", 4)], "path string, size bigint")
    found = {r.path: r.status for r in archive.archive_verify(manifest, listing).collect()}
    assert found == {"a": "ok", "b": "size_mismatch", "c": "missing", "z": "unexpected"}


def test_integrity(spark, tmp_path):
    requests = spark.createDataFrame(
        [("r", 1, "s", "completed", None), ("r", 1, "s", "completed", None), ("r", None, "s", "odd", None)],
        schemas.REQUESTS,
    )
    results = spark.createDataFrame([("r", 1, "t", 7), ("r", 2, "t", None), ("r", 2, "t", 1)], schemas.RESULTS)
    errors = spark.createDataFrame(
        [("r", 1, 1, "t", "c", "m", "u")] * 3 + [("r", 2, 8, "t", "c", "m", "u"), ("r", 3, None, "t", "c", "m", "u")],
        schemas.ERRORS,
    )
    issues = archive.integrity_check(requests, results, errors)
    assert {(r.issue, r.n) for r in issues.collect()} == {
        ("duplicate request id", 1),
        ("duplicate result id", 1),
        ("duplicate error id", 2),
        ("request without key", 1),
        ("unknown request status", 1),
        ("result flag not 0 or 1", 1),
        ("error without its request", 1),
    }
    where = str(tmp_path / "issues")
    with pytest.raises(RuntimeError, match="unsound: 7 rows.*\n.*duplicate") as raised:
        archive.require_none(issues, "unsound", where, shown=2)
    assert where in str(raised.value) and len(str(raised.value).splitlines()) == 3
    assert spark.read.parquet(where).count() == 7
    archive.require_none(issues.where(F.lit(False)), "unsound", where)


def test_seeds(spark):
    asked = spark.createDataFrame(
        [("a", '[{"x":{"n":1,"l":[1,2]},"y":{}},{"x":{}}]'), ("b", None), ("c", "[]")],
        "run_id string, seed_params string",
    )
    found = archive.seed_expand(asked).drop("seed_params")
    assert {tuple(r) for r in found.collect()} == {
        ("a", 0, "x", '{"n":1,"l":[1,2]}', False),
        ("a", 0, "y", "{}", False),
        ("a", 1, "x", "{}", False),
        ("b", None, None, None, True),
    }
    known = spark.createDataFrame([("a",), ("a",)], "run_id string")
    plan = {r.run_id: (r.action, r.seed_params) for r in archive.resume_plan(asked, known).collect()}
    assert plan == {"a": ("resume", None), "b": ("seed", None), "c": ("seed", "[]")}


def test_replayed_batch_changes_nothing(spark, first, tmp_path):
    root = str(tmp_path / "store")
    handle = streaming.archive_batch(root)
    handle(first, 0)
    later = downloads(
        spark,
        [("p/", "http://h/n.gif", "k2", None, "new", 7), ("p/", "http://h/a.pdf", "k1", None, "same", 8)],
    )
    handle(later, 1)

    def state():
        objects = streaming.stored_objects(spark, root).select("content_key", "first_seq", "batch_id")
        return (
            sorted(map(tuple, objects.collect())),
            sorted(map(tuple, streaming.stored_pointers(spark, root).collect())),
        )

    before = state()
    handle(later, 1)
    assert state() == before
    assert len(before[0]) == 5 and len(before[1]) == 3
    one = [r for r in before[1] if r[2].endswith(".gif")]
    assert len(one) == 1


def test_verification_by_digests(spark):
    """Equal to the comparison of all rows; a whole archive compares no row."""
    rng = random.Random(3)
    stored = [(f"a/{i:04d}", rng.randrange(1000)) for i in range(3000)]
    wanted = list(stored)
    for i in (5, 900, 2999):
        wanted[i] = (wanted[i][0], wanted[i][1] + 1)
    wanted = wanted[:100] + wanted[101:] + [("only/here", 7), ("no/size", None)] + [wanted[50]]
    schema = "path string, size long"
    manifest, listing = spark.createDataFrame(wanted, schema), spark.createDataFrame(stored, schema)
    found = sorted(map(tuple, archive.archive_differences(manifest, listing, shards=64).collect()), key=str)
    expected = archive.archive_verify(manifest, listing).where("status <> 'ok'")
    # The row that repeats is told by its shard's digest, and is no difference of paths and sizes.
    assert found == sorted(map(tuple, expected.collect()), key=str) and len(found) == 6
    assert archive.archive_differences(listing, listing.repartition(7)).collect() == []
    assert archive.archive_differences(listing.limit(0), listing.limit(0)).collect() == []
    assert archive.archive_differences(listing, listing.limit(0)).count() == 3000
    plan = archive.archive_differences(manifest, listing)._jdf.queryExecution().toString()
    assert plan.count("BroadcastExchange") == 2


def test_bytes_by_place(spark, tmp_path):
    """Equal to the join on bytes, in portions too; nothing is shuffled once the places are known."""
    rng = random.Random(5)
    rows = [("p/", f"http://h/{i}.pdf", None, None, f"text {rng.randrange(4000)}", rng.randrange(10**6)) for i in range(10_000)]
    rows += [("p/", "http://h/t.pdf", None, None, "tie", 7)] * 3 + [("p/", "http://h/n.pdf", None, None, None, 8)]
    folder = str(tmp_path / "downloads")
    downloads(spark, rows).coalesce(2).write.parquet(folder)
    table = placed(spark.read.schema(schemas.DOWNLOADS).parquet(folder))
    stored = archive.objects_of(table.where("seq % 3 = 0"))
    key = lambda r: (r.content_key, r.first_seq)
    joined = sorted({key(r): tuple(r) for r in archive.content_to_write(table, stored).where("content_key IS NOT NULL").collect()}.values())
    assert len(joined) > 500
    for most in (1, archive.MOST_MARKS):
        found = archive.content_by_place(table, stored, most).where("content_key IS NOT NULL")
        assert sorted(map(tuple, found.collect())) == joined
    plan = archive.content_by_place(table, stored)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"Exchange (hash|range|Round|Single)", plan)
    assert archive.content_by_place(table, archive.objects_of(table)).where("content_key IS NOT NULL").collect() == []
    assert archive.content_by_place(table.limit(0), stored).collect() == []


def test_batches_read_their_own_shards(spark, tmp_path):
    root = str(tmp_path / "store")
    handle = streaming.archive_batch(root)
    handle(downloads(spark, [("p/", f"http://h/{i}.pdf", None, None, f"text {i}", i) for i in range(300)]), 0)
    objects = streaming.stored_objects(spark, root)
    assert objects.count() == 300 and objects.select("shard").distinct().count() == 16
    shards = sorted(r.shard for r in objects.select("shard").distinct().collect())[:3]
    few = streaming.stored_objects(spark, root, shards)
    expected = objects.where(F.col("shard").isin(shards)).count()
    assert few.count() == expected and {f.split("shard=")[1].split("/")[0] for f in few.inputFiles()} == set(shards)
    assert streaming.stored_objects(spark, root, []).collect() == []
    handle(downloads(spark, []), 1)
    handle(downloads(spark, [("p/", "http://h/x.pdf", None, None, "text 5", 900)]), 2)
    assert streaming.stored_objects(spark, root).count() == 300


def test_streams_of_a_file_and_of_a_folder(spark, tmp_path):
    folder = str(tmp_path / "tables")
    spark.range(100).repartition(3).write.parquet(f"{folder}/many.parquet")
    spark.range(7).toPandas().to_parquet(f"{folder}/one.parquet")
    for name, rows in (("many", 100), ("one", 7)):
        to_parquet(read_stream(spark, folder, name), str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))
        assert spark.read.parquet(str(tmp_path / name)).count() == rows
