"""Streams with late rows, several batches and restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from crawlsight.operators import progress, triggers
from crawlsight.sources import schemas
from crawlsight.streaming import archive as archive_streaming
from crawlsight.streaming import timers, windows
from crawlsight.streaming.drain import drained_latest, to_parquet

START = dt.datetime(2024, 1, 1)


def write_batches(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/b{i}")


def read(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def requests(spark, tmp_path, shuffle_seconds):
    """Requests whose arrival order is shuffled by at most ``shuffle_seconds``."""
    rng = random.Random(1)
    rows = [
        ("r", i, "s", rng.choice(["completed", "failed"]), START + dt.timedelta(seconds=30 * i))
        for i in range(400)
    ]
    rows.sort(key=lambda r: (r[4] - START).total_seconds() + rng.uniform(0, shuffle_seconds))
    folder = str(tmp_path / "requests")
    write_batches(spark, folder, [rows[i : i + 100] for i in range(0, 400, 100)], schemas.REQUESTS)
    return spark.createDataFrame(rows, schemas.REQUESTS), folder


def test_progress_with_late_rows_equals_batch(spark, tmp_path):
    batch, folder = requests(spark, tmp_path, 500)
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    to_parquet(windows.progress_stream(read(spark, folder, schemas.REQUESTS)), sink, checkpoint)
    closed = batch.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    expected = progress.progress_windows(batch).where(F.col("snapshot_at") <= F.lit(closed))
    stream = windows.progress_stream(read(spark, folder, schemas.REQUESTS))
    whole = progress.running_totals(drained_latest(stream, "progress", ["run_id", "snapshot_at"]))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, progress.progress_windows(batch).collect()))
    found = progress.running_totals(spark.read.parquet(sink))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    # A restart from the checkpoint finds nothing new and writes nothing twice.
    to_parquet(windows.progress_stream(read(spark, folder, schemas.REQUESTS)), sink, checkpoint)
    again = progress.running_totals(spark.read.parquet(sink))
    assert again.count() == found.count()


def test_snapshots_of_three_streams_equal_batch(spark, tmp_path):
    """Requests, results and errors under one watermark, with a gap of a month between them."""
    batch, folder = requests(spark, tmp_path, 500)
    late = START + dt.timedelta(days=30)
    results = [(None if i % 9 == 0 else f"q{i % 2}", i % 3 if i % 5 else None, START + dt.timedelta(seconds=41 * i)) for i in range(150)]
    errors = [("q1", START + dt.timedelta(seconds=77 * i)) for i in range(40)] + [("r", late), ("q0", late)]
    kinds = {"results": (results, "run_id string, is_valid int, ts timestamp"), "errors": (errors, "run_id string, ts timestamp")}
    batches, streams = [batch], [read(spark, folder, schemas.REQUESTS)]
    for name, (rows, schema) in kinds.items():
        write_batches(spark, str(tmp_path / name), [rows[:30], rows[30:]], schema)
        batches.append(spark.createDataFrame(rows, schema))
        streams.append(read(spark, str(tmp_path / name), schema))
    # The errors a month later move the watermark past everything; the others keep the lateness of their own.
    stream = windows.progress_stream(*streams, lateness="60 days")
    found = progress.running_totals(drained_latest(stream, "progress", ["run_id", "snapshot_at"]))
    expected = progress.progress_windows(*batches).collect()
    assert sorted(map(str, found.collect())) == sorted(map(str, expected))
    last = max((r for r in expected if r.run_id == "r"), key=lambda r: r.snapshot_at)
    assert last.errors == 1 and last.results == 0 and last.total == batch.count() and last.status == "settled"
    assert sum(r.run_id == "r" for r in expected) > 30 * 288
    plan = progress.progress_windows(*batches)._jdf.queryExecution().toString()
    # Exchanges for the intervals, the window and the dealing out; none after the quiet intervals are made.
    final = plan[plan.index("== Physical Plan ==") :]
    assert final.count("Exchange") <= 3 and final.rindex("Generate") < final.index("Exchange")


def test_archive_over_several_batches(spark, tmp_path):
    rows = [
        ("p/", f"http://h/{i}.pdf", f"k{i % 7}", None, f"text {i % 13}", i) for i in range(60)
    ]
    folder, root = str(tmp_path / "downloads"), str(tmp_path / "store")
    write_batches(spark, folder, [rows[:20], rows[20:40], rows[40:]], schemas.DOWNLOADS)
    for _ in range(2):
        archive_streaming.archive_stream(
            read(spark, folder, schemas.DOWNLOADS), root, str(tmp_path / "checkpoint")
        )
        objects = archive_streaming.stored_objects(spark, root)
        assert objects.count() == objects.select("content_key").distinct().count() == 13
        assert archive_streaming.stored_pointers(spark, root).count() == 7
    assert objects.select("batch_id").distinct().count() >= 1


def test_telemetry_has_open_windows_and_exact_quantiles(spark, tmp_path):
    rng = random.Random(4)
    values = [round(rng.random() * 1000, 3) for _ in range(50_000)]
    rows = [(START, "worker.active", v, "r", "x", "p", "q", "1", None, "compress", None) for v in values]
    rows += [(START + dt.timedelta(minutes=i), "worker.active", float(i), run, "x", "p", "q", "1", None, "compress", None) for i in range(90) for run in "st"]
    folder = str(tmp_path / "metrics")
    write_batches(spark, folder, [rows[:20_000], rows[20_000:]], schemas.METRICS)
    stream = windows.telemetry_stream(read(spark, folder, schemas.METRICS))
    found = windows.telemetry_windows(drained_latest(stream, "t", [*windows.SERIES, "window_start", "value"])).collect()
    found = {(r.run_id, (r.window_start - START).seconds // 3600): r for r in found}
    values.sort()
    assert found["r", 0]["count"] == 50_000
    assert abs(found["r", 0].p50 - (values[24_999] + values[25_000]) / 2) < 1e-9
    for run in "st":
        assert [(found[run, h]["count"], found[run, h]["last"]) for h in (0, 1)] == [(60, 59.0), (30, 89.0)]


def test_trigger_stream_equals_batch(spark, tmp_path):
    """Frames of six hours that no aligned window has, one burst, late rows, events that do not match, a replay."""
    at = lambda hours: START + dt.timedelta(hours=hours)
    first = [(i, at(h), 1, "error", "{}") for i, h in enumerate((1.9, 4.0, 7.8))]
    burst = [(10 + i, at(20), 2, "error", "{}") for i in range(3)] + [(20, at(1), 3, "other", "{}")]
    rng = random.Random(9)
    busy = [(100 + i, at(30 + rng.random() * 40), 4 + i % 3, rng.choice(["error", "other"]), "{}") for i in range(300)]
    busy.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.uniform(0, 500)))
    batches = [first[:1], first[1:] + burst, *(busy[i : i + 60] for i in range(0, 300, 60))]
    folder = str(tmp_path / "events")
    write_batches(spark, folder, batches, schemas.EVENTS)
    whole = spark.createDataFrame([r for b in batches for r in b], schemas.EVENTS)
    expected = sorted(map(tuple, triggers.trigger_reactive(whole, ["error"], 3, 6 * 3600).collect()))
    assert (1, at(7.8), 3) in expected and [r for r in expected if r[0] == 2] == [(2, at(20), 3)]
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")
    for _ in range(2):
        stream = read(spark, folder, schemas.EVENTS)
        found = windows.trigger_stream(stream, root, checkpoint, ["error"], 3, 6 * 3600)
        assert sorted(map(tuple, found.collect())) == expected
    stored = spark.read.parquet(f"{root}/events")
    assert stored.count() == whole.where("event = 'error'").count()


def test_table_of_a_crashed_first_write(spark, tmp_path):
    """A folder without a finished file is an empty table, so the stream can start again."""
    (tmp_path / "objects" / "batch_id=0" / "_temporary" / "0").mkdir(parents=True)
    assert archive_streaming.stored_objects(spark, str(tmp_path)).collect() == []


def arriving(spark, tmp_path):
    """Events over days in batches, shuffled by up to 500 s, with quiet keys; the whole table, and its folder."""
    at = lambda hours: START + dt.timedelta(hours=hours)
    rng = random.Random(12)
    rows = [(i, at(rng.random() * 60), rng.randrange(4), rng.choice(["a", "b", "c", "other"]), "{}") for i in range(240)]
    # A key that is heard of once, and one that is followed up in time by a single event.
    rows += [(900, at(3), 77, "a", "{}"), (901, at(5), 78, "a", "{}"), (902, at(7), 78, "b", "{}")]
    rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.uniform(0, 500)))
    folder = str(tmp_path / "events")
    write_batches(spark, folder, [rows[i : i + 50] for i in range(0, len(rows), 50)], schemas.EVENTS)
    return spark.createDataFrame(rows, schemas.EVENTS), folder


CASES = {
    "proactive": (
        lambda rows, as_of: triggers.trigger_proactive(rows, ["a"], ["b"], 2, 6 * 3600, as_of),
        lambda stream, *where: timers.proactive_stream(stream, *where, ["a"], ["b"], 2, 6 * 3600),
    ),
    "compound": (
        lambda rows, as_of: triggers.trigger_compound(rows, [["a"], ["b"], ["c"]], 3, 2 * 3600),
        lambda stream, *where: timers.compound_stream(stream, *where, [["a"], ["b"], ["c"]], 3, 2 * 3600),
    ),
    "sequence": (
        lambda rows, as_of: triggers.trigger_sequence(rows, [["a"], ["b"], ["c"]], 5 * 3600),
        lambda stream, *where: timers.sequence_stream(stream, *where, [["a"], ["b"], ["c"]], 5 * 3600),
    ),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_triggers_with_timers_equal_batch(spark, tmp_path, name):
    """Late rows, many batches, a second run from the same checkpoint; quiet keys fire as time passes."""
    whole, folder = arriving(spark, tmp_path)
    batch, streamed = CASES[name]
    newest = whole.agg(F.max("ts")).first()[0]
    expected = sorted(map(tuple, batch(whole, newest).collect()))
    root, checkpoint = str(tmp_path / "root"), str(tmp_path / "checkpoint")
    for _ in range(2):
        found = streamed(read(spark, folder, schemas.EVENTS), root, checkpoint)
        assert expected and sorted(map(tuple, found.collect())) == expected
    if name == "proactive":
        # Written while the stream ran, although nothing more came for these keys.
        fired = spark.read.parquet(f"{root}/fired")
        assert {77, 78} <= {r.resource for r in fired.collect()}
    # What is kept does not grow with the batches.
    assert len(list((tmp_path / "root" / "open").glob("batch_id=*"))) <= 2


def test_a_repeated_batch_of_timers_changes_nothing(spark, tmp_path):
    """The newest batch is done again, as after a crash before its commit."""
    whole, folder = arriving(spark, tmp_path)
    batch, streamed = CASES["proactive"]
    expected = sorted(map(tuple, batch(whole, whole.agg(F.max("ts")).first()[0]).collect()))
    root, checkpoint = str(tmp_path / "root"), tmp_path / "checkpoint"
    streamed(read(spark, folder, schemas.EVENTS), root, str(checkpoint))
    last = max((int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit()))
    for left in (checkpoint / "commits").glob(f"*{last}*"):
        left.unlink()
    found = streamed(read(spark, folder, schemas.EVENTS), root, str(checkpoint))
    assert sorted(map(tuple, found.collect())) == expected


def test_proactive_streams_need_an_after_event(spark, tmp_path):
    with pytest.raises(ValueError):
        timers.proactive_stream(spark.createDataFrame([], schemas.EVENTS), "r", "c", [], ["b"], 1, 60)


def test_sketches_do_not_grow_with_distinct_values(spark, tmp_path):
    """50,000 different values in several batches: ranks within the stated error, a state of bounded size."""
    rng = random.Random(8)
    values = [rng.random() * 1000 for _ in range(50_000)]
    row = lambda i, v, run: (START + dt.timedelta(milliseconds=i), "worker.active", v, run, "x", "p", "q", "1", None, "compress", None)
    rows = [row(i, v, "r") for i, v in enumerate(values)] + [row(i, float(i), "few") for i in range(9)] + [row(1, None, "none"), row(1, float("nan"), "nan")]
    folder = str(tmp_path / "metrics")
    write_batches(spark, folder, [rows[i : i + 20_000] for i in range(0, len(rows), 20_000)], schemas.METRICS)
    stream = windows.telemetry_sketch_stream(read(spark, folder, schemas.METRICS))
    states = drained_latest(stream, "sketch", [*windows.SERIES, "window_start"])
    sizes = {r.run_id: r.n for r in states.select("run_id", F.length("sketch").alias("n")).collect()}
    assert sizes["r"] < 25_000 and set(sizes) == {"r", "few", "nan"}
    found = {r.run_id: r for r in windows.sketched_quantiles(states).collect()}
    ordered = sorted(values)
    for name, p in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
        q = found["r"][name]
        assert q in values and abs(sum(v <= q for v in ordered) / 50_000 - p) < windows.SKETCH_ERROR
    assert found["r"]["count"] == 50_000 and found["r"]["last"] == values[-1]
    assert (found["few"].p50, found["few"].min, found["few"].max) == (4.0, 0.0, 8.0)
    assert found["nan"].p50 is None and found["nan"]["count"] == 1
