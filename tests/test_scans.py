"""Sliced scans, exact quantiles and triggers against brute force on random rows."""

import datetime as dt
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlsight.operators import history, sla, telemetry, triggers
from crawlsight.operators.quantiles import exact_quantiles
from crawlsight.operators import scans
from crawlsight.operators.scans import running, since, sliced, unsliced
from crawlsight.sources import schemas

START = dt.datetime(2024, 1, 1)


def at(second):
    return START + dt.timedelta(seconds=second)


def seconds(moment):
    return (moment - START).total_seconds()


@pytest.fixture(scope="module")
def points():
    """Unique (key, second) points; one key holds most of them, one key is NULL."""
    rng = random.Random(3)
    chosen = {(rng.choice(["hot", "hot", "hot", "b", None]), rng.randrange(0, 4000)) for _ in range(900)}
    return sorted(((k, s, rng.randrange(1, 9)) for k, s in chosen), key=str)


@pytest.mark.parametrize("width", [7, 300, 100_000])
def test_running(spark, points, width):
    frame = spark.createDataFrame([(k, at(s), v) for k, s, v in points], "k string, ts timestamp, v bigint")
    scanned = unsliced(
        running(sliced(frame, ["k"], slice_seconds=width), {"total": "v"}, {"top": "v"}, {"prev": "v"})
    )
    found = {(r.k, seconds(r.ts)): (r.total, r.top, r.prev) for r in scanned.collect()}
    by_key = defaultdict(list)
    for k, s, v in sorted(points, key=lambda p: p[1]):
        seen = by_key[k]
        assert found[(k, s)] == (sum(seen) + v, max(seen, default=None), seen[-1] if seen else None)
        seen.append(v)


@pytest.mark.parametrize("within", [1, 60, 900])
def test_since(spark, points, within):
    frame = spark.createDataFrame([(k, at(s), v) for k, s, v in points], "k string, ts timestamp, v bigint")
    found = {(r.k, seconds(r.ts)): (r.v, r.v_since) for r in since(frame, ["k"], ["v"], within).collect()}
    for k, s, v in points:
        frame_sum = sum(w for j, u, w in points if j == k and s - within <= u <= s)
        assert found[(k, s)] == (v, frame_sum)


def test_quantiles(spark):
    rng = random.Random(5)
    groups = {
        "one": [4.25],
        "same": [2.0] * 50,
        "mixed": [rng.uniform(-5, 5) for _ in range(400)] + [0.0] * 30,
        "wide": [10 ** rng.uniform(-12, 12) for _ in range(500)],
        None: [rng.gauss(0, 1e-6) for _ in range(100)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None)]
    frame = spark.createDataFrame(rows, "k string, v double")
    probs = (0.0, 0.25, 0.5, 0.99, 1.0)
    found = {r.k: r for r in exact_quantiles(frame, ["k"], "v", probs).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        row = found[key]
        assert row["count"] == len(values) and row["min"] == min(values) and row["max"] == max(values)
        assert row["sum"] == pytest.approx(sum(values))
        got = [row["p0"], row["p25"], row["p50"], row["p99"], row["p100"]]
        assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-18)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(9)
    names = ["view", "click", "purchase"]
    return [
        (i, rng.choice([0, 0, 1]), rng.choice(names), rng.randrange(0, 3000), '{"k": %d}' % rng.randrange(3))
        for i in range(500)
    ]


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame([(i, at(s), r, e, p) for i, r, e, s, p in events], schemas.EVENTS)


def fired(frame):
    return sorted((r.resource, seconds(r.fired_at)) for r in frame.collect())


def moments(events, names=None):
    out = defaultdict(lambda: defaultdict(list))
    for _, r, e, s, _ in events:
        if names is None or e in names:
            out[r][s].append(e)
    return out


def test_reactive(frame, events):
    expected = []
    for r, by in moments(events, {"click"}).items():
        for s in by:
            upto = sum(len(v) for u, v in by.items() if s - 60 <= u <= s)
            before = upto - len(by[s])
            if before < 4 <= upto:
                expected.append((r, s))
    assert expected
    assert fired(triggers.trigger_reactive(frame, ["click"], 4, 60)) == sorted(expected)


def test_match(frame, events):
    found = triggers.trigger_match(frame, [], {"k": ["0", "2"]}).count()
    assert found == sum('"k": 1' not in p for *_, p in events)
    assert triggers.trigger_match(frame, [], {"absent": "1"}).count() == 0


def test_proactive(frame, events):
    as_of, within = 2500, 120
    expected = []
    for r in {0, 1}:
        anchors = {s for _, q, e, s, _ in events if q == r and e == "view"}
        bought = [s for _, q, e, s, _ in events if q == r and e == "purchase"]
        for a in anchors:
            if sum(a < s <= a + within for s in bought) < 3 and a + within <= as_of:
                expected.append((r, a + within))
    assert expected
    found = triggers.trigger_proactive(frame, ["view"], ["purchase"], 3, within, at(as_of))
    assert fired(found) == sorted(expected)


def test_idle(spark):
    rows = [(1, at(10), 7, "beat", "{}"), (2, at(130), 7, "other", "{}"), (3, at(190), 7, "beat", "{}")]
    beats = spark.createDataFrame(rows, schemas.EVENTS)
    found = triggers.trigger_proactive(beats, [], ["beat"], 1, 60, at(301))
    assert fired(found) == [(7, 120.0), (7, 180.0), (7, 300.0)]


@pytest.mark.parametrize("require,need", [("any", 1), (2, 2), ("all", 3)])
def test_compound(frame, events, require, need):
    names, within = ["view", "click", "purchase"], 25
    expected = []
    for r, by in moments(events).items():
        for s in by:
            old = {e for u, v in by.items() if s - within <= u < s for e in v}
            if len(old) < need <= len(old | set(by[s])):
                expected.append((r, s))
    assert expected
    found = triggers.trigger_compound(frame, [[n] for n in names], require, within)
    assert fired(found) == sorted(expected)


def test_sequence(frame, events):
    within = 15
    expected = []
    for r, by in moments(events).items():
        for s in by:
            if "purchase" not in by[s]:
                continue
            chain = any(
                "view" in by[v] and "click" in by[c]
                for c in by
                if c < s
                for v in by
                if v < c and s - v <= within
            )
            if chain:
                expected.append((r, s))
    assert expected
    found = triggers.trigger_sequence(frame, [["view"], ["click"], ["purchase"]], within)
    assert fired(found) == sorted(expected)


def test_metric_trigger(spark):
    rng = random.Random(2)
    values = {s: rng.choice([1, 1, 5, 9]) for s in sorted(rng.sample(range(0, 4000), 300))}
    rows = [(at(s), "lag", float(v), "r", "x", "p", "q", "1", None, "compress", None) for s, v in values.items()]
    metrics = spark.createDataFrame(rows, schemas.METRICS)
    expected, start, done = [], None, False
    for s in sorted(values):
        frame = [v for u, v in values.items() if s - 50 <= u <= s]
        if sum(frame) / len(frame) > 4:
            start = s if start is None else start
            if s - start >= 40 and not done:
                expected.append((s, start))
                done = True
        else:
            start, done = None, False
    assert expected
    found = triggers.trigger_metric(metrics, "lag", ">", 4, 50, 40)
    assert sorted((seconds(r.fired_at), seconds(r.breach_since)) for r in found.collect()) == expected


def test_gaps(spark):
    moments = spark.createDataFrame([("a", at(0)), ("a", at(50)), ("b", at(190))], "k string, ts timestamp")
    found = sla.gaps(moments, ["k"], 20, at(200))
    assert sorted((r.k, seconds(r.last_at), r.seconds, r.is_open) for r in found.collect()) == [
        ("a", 0.0, 50.0, False),
        ("a", 50.0, 150.0, True),
    ]


def run_row(run_id, queue, start, end, state="COMPLETED", scheduled=0, name="n", attempt=0):
    return (
        run_id, name, attempt, queue, at(scheduled),
        None if start is None else at(start), None if end is None else at(end), state,
    )


def test_concurrency(spark):
    flow = spark.createDataFrame(
        [
            run_row(1, "q", 0, 10),
            run_row(2, "q", 10, 20),
            run_row(3, "q", 12, None, "RUNNING"),
            run_row(4, "q", 5, 5),
            run_row(5, "q", None, None, "SCHEDULED"),
        ],
        schemas.FLOW_RUNS,
    )
    queues = spark.createDataFrame([("q", 1, False)], schemas.QUEUES)
    assert tuple(history.concurrency_audit(flow, queues).first()) == ("q", 1, 2, 1)


def test_metric_trigger_with_numbers_of_any_size(spark):
    inf, nan = float("inf"), float("nan")
    at = lambda i: START + dt.timedelta(seconds=10 * i)
    series = {
        "tiny": [4e-7] * 9, "huge": [1e15, 1e300] * 4, "inf": [inf] * 9, "nan": [nan] * 9, "both": [inf, -inf] * 4,
        "one": [0.0] * 3 + [inf] + [0.0] * 12, "below": [-inf] * 9,
    }
    rows = [(at(i), "lag", v, run, "x", "p", "q", "1", None, "compress", None) for run, values in series.items() for i, v in enumerate(values)]
    metrics = spark.createDataFrame(rows, schemas.METRICS)
    fired = lambda compare, limit: {
        r.run_id: r.fired_at for r in triggers.trigger_metric(metrics, "lag", compare, limit, 20, 20).collect()
    }
    assert fired(">", 1e-7) == {"tiny": at(2), "huge": at(2), "inf": at(2), "one": at(5)}
    assert fired("<", -1.0) == {"below": at(2)}


def test_admissible(spark):
    flow = spark.createDataFrame(
        [run_row(0, "q", 0, None, "RUNNING")]
        + [run_row(i, "q", None, None, "SCHEDULED", scheduled=100 - i) for i in range(1, 9)]
        + [run_row(i, "paused", None, None, "SCHEDULED") for i in range(20, 22)],
        schemas.FLOW_RUNS,
    )
    queues = spark.createDataFrame([("q", 4, False), ("paused", 9, True)], schemas.QUEUES)
    found = history.admissible_runs(flow, queues).orderBy("rank").collect()
    assert [(r.run_id, r["rank"]) for r in found] == [(8, 1), (7, 2), (6, 3)]
    unlimited = spark.createDataFrame([("q", None, False), ("paused", None, True)], schemas.QUEUES)
    found = history.admissible_runs(flow, unlimited).orderBy("rank").collect()
    assert [r.run_id for r in found] == [8, 7, 6, 5, 4, 3, 2, 1]


def test_drained(spark):
    flow = spark.createDataFrame(
        [
            run_row(1, "q", 0, 1, "CANCELLED", name="a", attempt=0),
            run_row(2, "q", 2, 3, "COMPLETED", name="a", attempt=1),
            run_row(3, "q", 0, 1, "COMPLETED", name="b", attempt=0),
            run_row(4, "q", 2, 3, "CANCELLED", name="b", attempt=1),
            run_row(5, "q", 2, 3, "COMPLETED", name="c", attempt=0),
        ],
        schemas.FLOW_RUNS,
    )
    assert {r.run_name: r.resumed for r in history.drained_runs(flow).collect()} == {"a": True, "b": False}


def test_schedules(spark):
    schedules = spark.createDataFrame(
        [("a", at(0), 100, 3), ("b", at(50), 100, 99), ("late", at(9999), 10, 5)],
        "queue string, anchor timestamp, interval_seconds bigint, max_scheduled_runs bigint",
    )
    found = sla.schedule_expand(schedules, at(450))
    assert sorted((r.queue, seconds(r.expected_at)) for r in found.collect()) == [
        ("a", 0.0), ("a", 100.0), ("a", 200.0),
        ("b", 50.0), ("b", 150.0), ("b", 250.0), ("b", 350.0), ("b", 450.0),
    ]
    flow = spark.createDataFrame([run_row(1, "a", 1, 2, scheduled=199), run_row(2, "b", 1, 2, scheduled=50)], schemas.FLOW_RUNS)
    missed = sla.missed_runs(schedules, flow, at(450))
    assert sorted((r.queue, r.slot) for r in missed.collect()) == [
        ("a", 0), ("a", 2), ("b", 1), ("b", 2), ("b", 3), ("b", 4),
    ]


def test_disabled_rules_and_default_severity():
    assert sla.Sla("x", duration=1).kind == "time_to_completion"
    assert sla.Sla("x", within=1).kind == "lateness"
    assert sla.Sla("x", within=1, expected_event="e").kind == "freshness"
    assert sla.Sla("x", stale_after=1).kind == "frequency"
    assert sla.DEFAULT_SEVERITY in sla.SEVERITIES


def span(i, parent, secs=1.0, trace=1):
    return (i, trace, parent, "x", START, secs, "s3", "c", "st", None)


def test_span_tree_any_depth_and_orphans(spark):
    chain = [span(0, None)] + [span(i, i - 1) for i in range(1, 40)]
    orphans = [span(100, 99, 5.0), span(101, 100, 2.0), span(102, 100, 1.0)]
    other_trace = [span(500, 0, trace=2)]
    frame = spark.createDataFrame(chain + orphans + other_trace, schemas.SPANS)
    found = {r.span_id: (r.depth, r.self_seconds) for r in telemetry.span_tree(frame).collect()}
    assert [found[i][0] for i in range(40)] == list(range(40))
    assert (found[100], found[101], found[500]) == ((0, 2.0), (1, 2.0), (0, 1.0))
    cycle = spark.createDataFrame([span(1, 2), span(2, 1)], schemas.SPANS)
    hanging = cycle.unionByName(spark.createDataFrame([span(3, 2), span(4, 3), span(10, None), span(11, 10)], schemas.SPANS))
    found = {r.span_id: r.depth for r in telemetry.span_depths(hanging).collect()}
    assert found == {1: None, 2: None, 3: None, 4: None, 10: 0, 11: 1}


def test_span_depths_of_random_forests(spark):
    """Forests, orphans, cycles and spans of no trace against a walk; leaves take no part in the rounds."""
    rng = random.Random(11)
    up = {(t, i): rng.choice([None, i - 1, i - 1, rng.randrange(60), 900]) for t in range(8) for i in range(60)}

    def walk(t, i):
        depth, seen = 0, set()
        while (t, up[t, i]) in up:
            if i in seen:
                return None
            seen.add(i)
            depth, i = depth + 1, up[t, i]
        return depth

    rows = [span(i, parent, trace=t) for (t, i), parent in up.items()]
    frame = spark.createDataFrame([*rows, span(1, None, trace=None), span(2, 1, trace=None)], schemas.SPANS)
    found = {(r.trace_id, r.span_id): r.depth for r in telemetry.span_depths(frame).collect()}
    assert found == {**{key: walk(*key) for key in up}, (None, 1): 0, (None, 2): 0}
    assert None in found.values() and max(d or 0 for d in found.values()) > 4
    parents = {(t, p) for (t, _), p in up.items() if (t, p) in up}
    assert {(r.trace_id, r.span_id) for r in telemetry._parent_depths(frame).collect()} == parents
    twice = spark.createDataFrame([span(1, None), span(1, None), span(2, 1), span(2, 1)], schemas.SPANS)
    assert sorted((r.span_id, r.depth) for r in telemetry.span_tree(twice).collect()) == [(1, 0), (1, 0), (2, 1), (2, 1)]
    assert telemetry.span_tree(frame.limit(0)).collect() == []


def test_sampling(spark):
    assert telemetry.sample_ratio(None) == 0.05
    assert telemetry.sample_ratio("always_on") == telemetry.sample_ratio("1.0") == 1.0
    assert telemetry.sample_ratio("0.25") == 0.25
    assert telemetry.sample_ratio("rubbish") == 0.05
    traces = spark.range(0, 40_000).select(F.col("id").alias("span_id"), F.floor(F.col("id") / 4).alias("trace_id"))
    kept = telemetry.trace_sample(traces, 0.05)
    share = kept.count() / 40_000
    assert 0.04 < share < 0.06
    assert kept.groupBy("trace_id").count().where("count <> 4").count() == 0
    assert telemetry.trace_sample(traces, 1.0).count() == 40_000


@pytest.mark.parametrize(
    "signals,label",
    [
        ({"event_loop.lag": 9, "request.cpu_time": 9}, "cpu_saturated"),
        ({"db.lock.wait": 9}, "db_lock_bound"),
        ({"rate_limiter.gate": 9}, "rate_limited"),
        ({"event_loop.lag": 0.001}, "io_bound"),
        ({"event_loop.lag": 9}, "unclear"),
    ],
)
def test_diagnosis(spark, signals, label):
    metrics = spark.createDataFrame(
        [(START, m, float(v), "r", "x", "p", "q", "1", None, "compress", None) for m, v in signals.items() if m != "rate_limiter.gate"],
        schemas.METRICS,
    )
    spans = spark.createDataFrame(
        [(1, 1, None, m, START, float(v), "s3", "x", "s", "r") for m, v in signals.items() if m == "rate_limiter.gate"],
        schemas.SPANS,
    )
    assert telemetry.bottleneck_diagnosis(metrics, spans).first().diagnosis == label


def test_a_million_moments_of_one_second_are_split(spark):
    """One key, one second: many tasks' worth of parts, and the values of a plain window."""
    rows = spark.range(1_000_000).selectExpr("'k' AS key", "timestamp_micros(1704067200000000 + (id * 7919) % 1000000) AS ts", "id % 10 AS v")
    parts = scans.parted(scans.sliced(rows, ["key"])).groupBy("_slice", "_part").count().collect()
    assert len({r._slice for r in parts}) == 1
    assert len(parts) > 8 and max(r["count"] for r in parts) < 10 * scans.SLICE_ROWS
    scanned = unsliced(running(sliced(rows, ["key"]), sums={"total": "v"}, maxes={"top": "v"}, previous={"last": "v"}))
    plain = spark.sql(
        """SELECT key, ts, v, sum(v) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS total,
           max(v) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top,
           lag(v) OVER (PARTITION BY key ORDER BY ts) AS last FROM {rows}""", rows=rows)
    digest = F.sum(F.xxhash64("key", "ts", "v", "total", "top", "last").cast("decimal(38,0)"))
    assert scanned.select(plain.columns).agg(digest).first() == plain.agg(digest).first()
    plan = scanned._jdf.queryExecution().toString()
    final = plan[plan.index("== Physical Plan ==") :]
    # No window over a whole key but the one over the totals of parts.
    assert final.count("_slice#") and not re.search(r"Window \[[^]]*\], \[_key#\d+\], \[_at#", final)


def test_ties_of_one_moment_are_split(spark, monkeypatch):
    monkeypatch.setattr(scans, "SLICE_ROWS", 50)
    rows = spark.range(2000).selectExpr("id % 3 AS key", "timestamp_seconds(id % 2) AS ts", "id AS run", "id % 7 AS v")
    parted = scans.parted(scans.sliced(rows, ["key"]), ["run"])
    assert max(r["count"] for r in parted.groupBy("_key", "_slice", "_part").count().collect()) < 500
    found = unsliced(running(sliced(rows, ["key"]), sums={"total": "v"}, previous={"last": "v"}, ties=["run"]))
    plain = spark.sql(
        """SELECT key, ts, run, v, sum(v) OVER (PARTITION BY key ORDER BY ts, run ROWS UNBOUNDED PRECEDING) AS total,
           lag(v) OVER (PARTITION BY key ORDER BY ts, run) AS last FROM {rows}""", rows=rows)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@pytest.mark.parametrize("seconds", [60, 61, 90, 3600, 86_400 * 30])
@pytest.mark.parametrize("blocks", [2, 5, 1000])
def test_frames_of_any_length(spark, seconds, blocks):
    r = random.Random(seconds + blocks)
    spread = seconds * 4
    moments = sorted({(r.choice(["a", "b", None]), START + dt.timedelta(microseconds=r.randrange(spread * 1_000_000))) for _ in range(300)}, key=str)
    # Both ends of a frame belong to it.
    moments += [("c", START + dt.timedelta(seconds=seconds * i)) for i in range(4)]
    rows = [(k, t, r.randrange(100)) for k, t in moments]
    points = spark.createDataFrame(rows, "key string, ts timestamp, v long")
    found = {(x.key, x.ts): x.v_since for x in scans.frame_sums(points, ["key"], ["v"], seconds, blocks=blocks).collect()}
    assert len(found) == len(rows)
    for k, t, _ in rows:
        assert found[k, t] == sum(v for k2, u, v in rows if k2 == k and t - dt.timedelta(seconds=seconds) <= u <= t)


def test_a_long_frame_over_a_hot_series_is_split(spark):
    """Thirty days of lookback, one series: no block of a task has more than a few hundredths of the rows."""
    rows = spark.range(60_000).selectExpr("'k' AS key", "timestamp_micros(1704067200000000 + id * 86400000) AS ts", "CAST(id % 9 AS double) AS v")
    lookback = 86_400 * 30
    block = lookback * 1_000_000 // scans.FRAME_BLOCKS
    assert max(r["count"] for r in rows.groupBy(F.floor(F.unix_micros("ts") / block)).count().collect()) < 600
    found = scans.frame_sums(rows, ["key"], ["v"], lookback).agg(F.sum(F.xxhash64("ts", "v_since").cast("decimal(38,0)"))).first()
    plain = spark.sql(
        "SELECT ts, sum(v) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS v_since FROM {rows}", rows=rows
    )
    assert found == plain.agg(F.sum(F.xxhash64("ts", "v_since").cast("decimal(38,0)"))).first()
    plan = scans.frame_sums(rows, ["key"], ["v"], lookback)._jdf.queryExecution().toString()
    assert not re.search(r"Window \[[^]]*\], \[_key#\d+\]", plan)


def test_two_schedules_on_a_queue(spark):
    """An hourly and a daily schedule, four hourly runs on the first day, then nothing for three days."""
    schedules = spark.createDataFrame(
        [("q", "hourly", at(0), 3600, 999), ("q", "daily", at(0), 86_400, 999)],
        "queue string, schedule_id string, anchor timestamp, interval_seconds bigint, max_scheduled_runs bigint",
    )
    flow = spark.createDataFrame([run_row(i, "q", 1, 2, scheduled=3600 * i) for i in range(4)], schemas.FLOW_RUNS)
    missed = [(r.schedule_id, r.slot) for r in sla.missed_runs(schedules, flow, at(3 * 86_400)).collect()]
    assert sorted(missed) == [("daily", i) for i in (1, 2, 3)] + [("hourly", i) for i in range(4, 73)]
    # Runs that name their schedule stand for that one alone.
    own = flow.withColumn("schedule_id", F.lit("hourly"))
    missed = [(r.schedule_id, r.slot) for r in sla.missed_runs(schedules, own, at(86_400)).collect()]
    assert ("daily", 0) in missed and ("hourly", 0) not in missed


def test_rows_counted_out(spark):
    from crawlsight.functions.steps import counted_out

    rows = spark.createDataFrame([("a", 1), ("b", 1024), ("c", 3000), ("d", 0), ("e", None), ("f", -2)], "k string, n long")
    found = counted_out(rows, F.col("n"), "i").groupBy("k").agg(F.count("*"), F.min("i"), F.max("i"), F.countDistinct("i"))
    assert sorted(map(tuple, found.collect())) == [("a", 1, 0, 0, 1), ("b", 1024, 0, 1023, 1024), ("c", 3000, 0, 2999, 3000)]


@pytest.mark.parametrize(
    "allowed, fits",
    [("a", ["a"]), (["a", "b"], ["a", "b"]), ("a*", ["a", "ab"]), ("!a", ["ab", "b"]), (["a*", "!ab"], ["a"]), (["b", "!a*"], ["b"]), ("*", ["a", "ab", "b"])],
)
def test_label_patterns(spark, allowed, fits):
    rows = spark.createDataFrame([('{"l": "%s"}' % v,) for v in ("a", "ab", "b")] + [("{}",), (None,)], "props string")
    found = rows.where(triggers.label_fits(triggers.label("l"), allowed)).select(triggers.label("l")).collect()
    assert sorted(r[0] for r in found) == fits


def test_for_each_label(spark):
    rows = [(START + dt.timedelta(seconds=i), "e", '{"a": "%d", "b": "x"}' % (i % 2)) for i in range(6)] + [(START, "e", '{"a": "0"}'), (START, "e", None)]
    events = triggers.for_each(spark.createDataFrame(rows, "ts timestamp, event string, props string"), {"a": "a", "b": "b"})
    found = triggers.trigger_reactive(events, ["e"], 3, 100, keys=("a", "b")).collect()
    assert sorted((r.a, r.b, r.events, (r.fired_at - START).seconds) for r in found) == [("0", "x", 3, 4), ("1", "x", 3, 5)]
