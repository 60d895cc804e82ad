"""Trigger, service-level and schedule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sla, triggers
from .registry import ORACLES, QUERIES, query

HOUR = 3600
DAY = 24 * HOUR
EVENTS = ("trigger_events",)
RUNS = ("flow_runs",)
SECONDS = "(epoch_us({end}) - epoch_us({start})) / 1000000.0::DOUBLE"


def latest(table, column):
    """The newest time of a table, as a subquery of one row: no job runs while the plan is made."""
    return table.agg(F.max(column)).scalar()


@query(
    "trigger_reactive",
    EVENTS,
    """WITH m AS (SELECT resource, ts, count(*) AS n FROM trigger_events WHERE event IN ('error', 'view') GROUP BY 1, 2),
c AS (SELECT *, sum(n) OVER (PARTITION BY resource ORDER BY ts RANGE BETWEEN INTERVAL 21600 SECONDS PRECEDING
  AND CURRENT ROW) AS k FROM m)
SELECT resource, ts AS fired_at, CAST(k AS BIGINT) AS events FROM c WHERE k >= 3 AND k - n < 3""",
)
def _(t):
    return triggers.trigger_reactive(t("trigger_events"), ["error", "view"], 3, 6 * HOUR)


@query(
    "trigger_proactive",
    EVENTS,
    """WITH a AS (SELECT DISTINCT resource, ts FROM trigger_events WHERE event = 'signup'),
e AS (SELECT resource, ts FROM trigger_events WHERE event = 'purchase'),
c AS (SELECT a.resource, a.ts AS after_at, count(e.ts) AS events FROM a LEFT JOIN e ON a.resource = e.resource
  AND e.ts > a.ts AND e.ts <= a.ts + INTERVAL 172800 SECONDS GROUP BY 1, 2)
SELECT resource, after_at, events, after_at + INTERVAL 172800 SECONDS AS fired_at FROM c
WHERE events < 2 AND after_at + INTERVAL 172800 SECONDS <= (SELECT max(ts) FROM trigger_events)""",
)
def _(t):
    events = t("trigger_events")
    return triggers.trigger_proactive(
        events, ["signup"], ["purchase"], 2, 2 * DAY, latest(events, "ts")
    )


@query(
    "trigger_proactive_idle",
    EVENTS,
    """WITH k AS (SELECT resource, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS slot,
    count(*) FILTER (event = 'purchase') AS n FROM trigger_events GROUP BY 1, 2),
z AS (SELECT CAST(floor(epoch_us(max(ts)) / 86400000000) AS BIGINT) - 1 AS last FROM trigger_events),
s AS (SELECT resource, unnest(range(min(slot), max(z.last) + 1)) AS slot FROM k, z GROUP BY 1)
SELECT s.resource, make_timestamp((s.slot + 1) * 86400000000) AS fired_at, coalesce(k.n, 0) AS events
FROM s LEFT JOIN k ON k.resource = s.resource AND k.slot = s.slot WHERE coalesce(k.n, 0) < 1""",
)
def _(t):
    events = t("trigger_events")
    return triggers.trigger_proactive(events, [], ["purchase"], 1, DAY, latest(events, "ts"))


@query(
    "trigger_match",
    EVENTS,
    """SELECT event_id, resource, event, ts FROM trigger_events WHERE event IN ('click', 'error')
AND json_extract_string(props, '$.k') IN ('1', '2', '3', '5', '8', '13')""",
)
def _(t):
    matched = triggers.trigger_match(
        t("trigger_events"), ["click", "error"], {"k": ["1", "2", "3", "5", "8", "13"]}
    )
    return matched.select("event_id", "resource", "event", "ts")


@query(
    "trigger_for_each",
    ("labelled_events",),
    """WITH e AS (SELECT json_extract_string(props, '$.site') AS site, json_extract_string(props, '$.kind') AS kind, ts FROM labelled_events),
m AS (SELECT site, kind, ts, count(*) AS n FROM e WHERE (site LIKE 'court-%' OR site = 'blog') AND site <> 'court-4' AND kind IS NOT NULL
  GROUP BY 1, 2, 3),
c AS (SELECT *, sum(n) OVER (PARTITION BY site, kind ORDER BY ts RANGE BETWEEN INTERVAL 21600 SECONDS PRECEDING
  AND CURRENT ROW) AS k FROM m)
SELECT site, kind, ts AS fired_at, CAST(k AS BIGINT) AS events FROM c WHERE k >= 3 AND k - n < 3""",
)
def _(t):
    """Two labels as keys; one of them with a pattern, a value and a forbidden value."""
    events = triggers.for_each(t("labelled_events"), {"site": "site", "kind": "kind"})
    return triggers.trigger_reactive(events, [], 3, 6 * HOUR, {"site": ["court-*", "blog", "!court-4"]}, keys=("site", "kind"))


def compound_sql(need: int, seconds: int, names: tuple[str, ...], head: str = "", table: str = "trigger_events") -> str:
    flags = ", ".join(f"max(ts) FILTER (event = '{n}') AS c{i}" for i, n in enumerate(names))
    before = ", ".join(
        f"max(c{i}) OVER (PARTITION BY resource ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m{i}"
        for i in range(len(names))
    )
    held = [f"coalesce(m{i} >= ts - INTERVAL {seconds} SECONDS, false)" for i in range(len(names))]
    old = " + ".join(f"CAST({h} AS INTEGER)" for h in held)
    now = " + ".join(f"CAST({h} OR c{i} IS NOT NULL AS INTEGER)" for i, h in enumerate(held))
    listed = ", ".join(f"'{n}'" for n in names)
    return f"""WITH {head}m AS (SELECT resource, ts, {flags} FROM {table} WHERE event IN ({listed}) GROUP BY 1, 2),
s AS (SELECT *, {before} FROM m)
SELECT resource, ts AS fired_at, {now} AS active FROM s WHERE {old} < {need} AND {now} >= {need}"""


CHILDREN = ("click", "view", "purchase")


@query("trigger_compound", EVENTS, compound_sql(3, 12 * HOUR, CHILDREN))
def _(t):
    return triggers.trigger_compound(t("trigger_events"), [[c] for c in CHILDREN], "all", 12 * HOUR)


@query("trigger_compound_any", EVENTS, compound_sql(1, 12 * HOUR, CHILDREN))
def _(t):
    return triggers.trigger_compound(t("trigger_events"), [[c] for c in CHILDREN], "any", 12 * HOUR)


@query("trigger_compound_count", EVENTS, compound_sql(2, 6 * HOUR, CHILDREN))
def _(t):
    return triggers.trigger_compound(t("trigger_events"), [[c] for c in CHILDREN], 2, 6 * HOUR)


@query(
    "trigger_sequence",
    EVENTS,
    """WITH m AS (SELECT resource, ts, bool_or(event = 'view') AS c0, bool_or(event = 'click') AS c1,
    bool_or(event = 'purchase') AS c2 FROM trigger_events WHERE event IN ('view', 'click', 'purchase') GROUP BY 1, 2),
a AS (SELECT *, CASE WHEN c1 THEN max(CASE WHEN c0 THEN ts END) OVER w END AS s1 FROM m
  WINDOW w AS (PARTITION BY resource ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, CASE WHEN c2 THEN max(s1) OVER w END AS s2 FROM a
  WINDOW w AS (PARTITION BY resource ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT resource, ts AS fired_at, s2 AS started_at FROM b WHERE s2 >= ts - INTERVAL 86400 SECONDS""",
)
def _(t):
    return triggers.trigger_sequence(t("trigger_events"), [["view"], ["click"], ["purchase"]], DAY)


def proactive_matched(t):
    events = t("trigger_events")
    labels = {"k": ["1", "2", "3", "5", "8", "13"]}
    return triggers.trigger_proactive(events, ["signup"], ["purchase"], 2, 2 * DAY, latest(events, "ts"), match=labels)


@query(
    "trigger_proactive_match",
    EVENTS,
    """WITH t AS (SELECT * FROM trigger_events WHERE json_extract_string(props, '$.k') IN ('1', '2', '3', '5', '8', '13')),
a AS (SELECT DISTINCT resource, ts FROM t WHERE event = 'signup'),
e AS (SELECT resource, ts FROM t WHERE event = 'purchase'),
c AS (SELECT a.resource, a.ts AS after_at, count(e.ts) AS events FROM a LEFT JOIN e ON a.resource = e.resource
  AND e.ts > a.ts AND e.ts <= a.ts + INTERVAL 172800 SECONDS GROUP BY 1, 2)
SELECT resource, after_at, events, after_at + INTERVAL 172800 SECONDS AS fired_at FROM c
WHERE events < 2 AND after_at + INTERVAL 172800 SECONDS <= (SELECT max(ts) FROM trigger_events)""",
)
def _(t):
    return proactive_matched(t)


PARTS = {"burst": "trigger_reactive", "unpaid": "trigger_proactive", "order": "trigger_sequence"}
FIRED = "fired AS ({}), ".format(
    " UNION ALL ".join(f"SELECT resource, fired_at AS ts, '{name}' AS event FROM ({ORACLES[sql]}) child_{name}" for name, sql in PARTS.items())
)


def parts(t):
    """Three children of different kinds: a threshold in a frame, a missing follow-up, an order of events."""
    return triggers.as_events({name: QUERIES[made](t.spark, t.folder) for name, made in PARTS.items()})


@query("trigger_composite", (), compound_sql(2, 2 * DAY, tuple(PARTS), FIRED, "fired"))
def _(t):
    return triggers.trigger_compound(parts(t), [[name] for name in PARTS], 2, 2 * DAY)


@query(
    "trigger_composite_sequence",
    (),
    f"""WITH {FIRED}m AS (SELECT resource, ts, bool_or(event = 'burst') AS c0, bool_or(event = 'order') AS c1 FROM fired
  WHERE event IN ('burst', 'order') GROUP BY 1, 2),
a AS (SELECT *, CASE WHEN c1 THEN max(CASE WHEN c0 THEN ts END) OVER (PARTITION BY resource ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS s1 FROM m)
SELECT resource, ts AS fired_at, s1 AS started_at FROM a WHERE s1 >= ts - INTERVAL {2 * DAY} SECONDS""",
)
def _(t):
    return triggers.trigger_sequence(parts(t), [["burst"], ["order"]], 2 * DAY)


@query(
    "trigger_metric",
    ("metrics",),
    """WITH p AS (SELECT run_id, ts, count(*) AS n, sum(value) AS s FROM metrics
  WHERE metric = 'event_loop.lag' AND value IS NOT NULL GROUP BY 1, 2),
f AS (SELECT run_id, ts, sum(s) OVER w / sum(n) OVER w AS mean FROM p
  WINDOW w AS (PARTITION BY run_id ORDER BY ts RANGE BETWEEN INTERVAL 43200 SECONDS PRECEDING AND CURRENT ROW)),
b AS (SELECT *, mean > 0.05 AND NOT isnan(mean) AS breach, lag(mean > 0.05 AND NOT isnan(mean)) OVER w AS prev_breach, lag(ts) OVER w AS prev_ts FROM f
  WINDOW w AS (PARTITION BY run_id ORDER BY ts)),
i AS (SELECT *, max(CASE WHEN breach AND NOT coalesce(prev_breach, false) THEN ts END)
  OVER (PARTITION BY run_id ORDER BY ts) AS since FROM b)
SELECT run_id, ts AS fired_at, since AS breach_since, round(mean, 9) AS mean FROM i
WHERE breach AND ts >= since + INTERVAL 21600 SECONDS
  AND NOT coalesce(prev_breach AND prev_ts >= since + INTERVAL 21600 SECONDS, false)""",
)
def _(t):
    fired = triggers.trigger_metric(t("metrics"), "event_loop.lag", ">", 0.05, 12 * HOUR, 6 * HOUR)
    return fired.withColumn("mean", F.round("mean", 9))


AS_OF = "(SELECT max(scheduled_at) FROM flow_runs)"


@query(
    "sla_time_to_completion",
    RUNS,
    f"""WITH d AS (SELECT queue, run_id, started_at AS "at",
    {SECONDS.format(start="started_at", end=f"coalesce(ended_at, {AS_OF})")} AS seconds
  FROM flow_runs WHERE started_at IS NOT NULL) SELECT * FROM d WHERE seconds > 86400""",
)
def _(t):
    runs = t("flow_runs")
    return sla.sla_time_to_completion(runs, DAY, latest(runs, "scheduled_at"))


GAPS = """WITH seen AS (SELECT DISTINCT {key}, {ts} AS ts FROM {source} WHERE {ts} <= {as_of} AND {where}),
points AS (SELECT {key}, ts, false AS is_open FROM seen
  UNION ALL SELECT {key}, {as_of}, true FROM seen GROUP BY 1 HAVING max(ts) < {as_of}),
g AS (SELECT {key}, is_open, ts, lag(ts) OVER (PARTITION BY {key} ORDER BY ts) AS last_at FROM points),
s AS (SELECT {key}, last_at, is_open, (epoch_us(ts) - epoch_us(last_at)) / 1000000.0::DOUBLE AS seconds FROM g)
SELECT * FROM s WHERE seconds > {limit}"""


@query(
    "sla_frequency",
    RUNS,
    GAPS.format(
        key="queue", ts="started_at", source="flow_runs", as_of=AS_OF, where="true", limit=180 * DAY
    ),
)
def _(t):
    runs = t("flow_runs")
    return sla.sla_frequency(runs, 180 * DAY, latest(runs, "scheduled_at"))


@query(
    "sla_freshness",
    EVENTS,
    GAPS.format(
        key="resource",
        ts="ts",
        source="trigger_events",
        as_of="(SELECT max(ts) FROM trigger_events)",
        where="event = 'purchase'",
        limit=DAY,
    ),
)
def _(t):
    events = t("trigger_events")
    return sla.sla_freshness(events, "purchase", DAY, latest(events, "ts"))


@query(
    "sla_lateness",
    RUNS,
    f"""WITH d AS (SELECT queue, run_id, scheduled_at AS "at",
    {SECONDS.format(start="scheduled_at", end=f"coalesce(started_at, {AS_OF})")} AS seconds FROM flow_runs)
SELECT * FROM d WHERE seconds > 3600""",
)
def _(t):
    runs = t("flow_runs")
    return sla.sla_lateness(runs, HOUR, latest(runs, "scheduled_at"))


SLAS = (
    sla.Sla("a run takes at most a day", duration=DAY, severity="moderate"),
    sla.Sla("a run takes at most 40 hours", duration=40 * HOUR, severity="critical"),
    sla.Sla("a run starts within the hour", within=HOUR),
    sla.Sla("a run starts within two hours", within=2 * HOUR, severity="minor", enabled=False),
    sla.Sla("purchases every day", expected_event="purchase", within=DAY, severity="low"),
    sla.Sla("a run every half year", stale_after=180 * DAY),
)


@query(
    "sla_severity_rollup",
    ("flow_runs", "trigger_events"),
    f"""WITH took AS (SELECT {SECONDS.format(start="started_at", end=f"coalesce(ended_at, {AS_OF})")} AS seconds
  FROM flow_runs WHERE started_at IS NOT NULL),
late AS (SELECT {SECONDS.format(start="scheduled_at", end=f"coalesce(started_at, {AS_OF})")} AS seconds FROM flow_runs),
bought AS ({GAPS.format(key="resource", ts="ts", source="trigger_events",
    as_of="(SELECT max(ts) FROM trigger_events)", where="event = 'purchase'", limit=DAY)}),
started AS ({GAPS.format(key="queue", ts="started_at", source="flow_runs", as_of=AS_OF, where="true",
    limit=180 * DAY)}),
v AS (SELECT 'moderate' AS severity, 'time_to_completion' AS kind FROM took WHERE seconds > 86400
  UNION ALL SELECT 'critical', 'time_to_completion' FROM took WHERE seconds > 144000
  UNION ALL SELECT 'high', 'lateness' FROM late WHERE seconds > 3600
  UNION ALL SELECT 'low', 'freshness' FROM bought
  UNION ALL SELECT 'high', 'frequency' FROM started)
SELECT severity, kind, count(*) AS violations, CAST(grouping(severity) * 2 + grouping(kind) AS INTEGER) AS level
FROM v GROUP BY CUBE (severity, kind)""",
)
def _(t):
    runs, events = t("flow_runs", "trigger_events")
    by_run = sla.violations([s for s in SLAS if s.kind != "freshness"], runs, events, latest(runs, "scheduled_at"))
    by_event = sla.violations([s for s in SLAS if s.kind == "freshness"], runs, events, latest(events, "ts"))
    return sla.sla_severity_rollup(by_run.unionByName(by_event))


EXPANDED = f"""WITH z AS (SELECT max(scheduled_at) AS until FROM flow_runs),
n AS (SELECT s.*, least(CAST(floor((epoch_us(z.until) - epoch_us(anchor)) / (interval_seconds * 1000000.0)) AS BIGINT)
    + 1, max_scheduled_runs) AS slots FROM schedules s, z),
x AS (SELECT *, unnest(range(0, slots)) AS slot FROM n),
expected AS (SELECT queue, schedule_id, slot, make_timestamp(epoch_us(anchor) + slot * interval_seconds * 1000000) AS expected_at
  FROM x)"""


@query(
    "schedule_expand",
    ("flow_runs", "schedules"),
    f"{EXPANDED} SELECT queue, schedule_id, slot, expected_at FROM expected",
)
def _(t):
    return sla.schedule_expand(t("schedules"), latest(t("flow_runs"), "scheduled_at"))


@query(
    "missed_runs",
    ("flow_runs", "schedules"),
    f"""{EXPANDED}, taken AS (SELECT DISTINCT s.schedule_id, CAST(floor((epoch_us(r.scheduled_at) - epoch_us(s.anchor))
    / (s.interval_seconds * 1000000.0)) AS BIGINT) AS slot FROM flow_runs r JOIN schedules s ON r.queue = s.queue)
SELECT queue, schedule_id, slot, expected_at FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.schedule_id = e.schedule_id AND t.slot = e.slot)""",
)
def _(t):
    runs = t("flow_runs")
    return sla.missed_runs(t("schedules"), runs, latest(runs, "scheduled_at"))
