"""Run analytics and progress statistics over the derived run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import progress, runs
from ..sources import schemas
from ..sources.tables import optional_table
from .registry import query

# Pieces of the checks that several queries share.
STATUS = """requests_by_status AS (
  SELECT run_id, continuation, status, count(*) AS n FROM requests GROUP BY ALL)"""
STEPS = """error_steps AS (
  SELECT e.run_id, r.continuation, e.error_type, count(*) AS n
  FROM errors e LEFT JOIN requests r ON e.run_id = r.run_id AND e.request_id = r.id GROUP BY ALL)"""
TYPES = """result_types AS (
  SELECT run_id, result_type, sum(is_valid) AS valid,
    sum(CASE WHEN is_valid <> 0 THEN 0 ELSE 1 END) AS invalid FROM results GROUP BY ALL)"""
TOP = """top_errors AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY id) AS rank FROM errors
  QUALIFY rank <= 50)"""


def pivot_sql(name: str, source: str, row: str, col: str, row_header: str, col_header: str) -> str:
    """CTEs that render ``source`` as a markdown pivot named ``name``."""
    return f"""{name}_cells AS (
  SELECT run_id, coalesce({row}, '(unknown)') AS r, coalesce({col}, '(unknown)') AS c, sum(n) AS n
  FROM {source} GROUP BY ALL),
{name}_cols AS (SELECT run_id, c, sum(n) AS n FROM {name}_cells GROUP BY ALL),
{name}_rows AS (SELECT run_id, r, sum(n) AS n FROM {name}_cells GROUP BY ALL),
{name}_grid AS (
  SELECT x.run_id, x.r, x.n AS total, y.c, z.n FROM {name}_rows x
  JOIN {name}_cols y ON x.run_id = y.run_id
  LEFT JOIN {name}_cells z ON z.run_id = x.run_id AND z.r = x.r AND z.c = y.c),
{name}_lines AS (
  SELECT run_id, r, '| ' || r || ' | ' || string_agg(CASE WHEN coalesce(n, 0) = 0 THEN ''
      ELSE CAST(CAST(n AS BIGINT) AS VARCHAR) END, ' | ' ORDER BY c)
    || ' | **' || CAST(CAST(total AS BIGINT) AS VARCHAR) || '** |' AS line
  FROM {name}_grid GROUP BY run_id, r, total),
{name}_heads AS (
  SELECT run_id, '| {row_header} \\ {col_header} | ' || string_agg(c, ' | ' ORDER BY c) || ' | **Total** |'
      || chr(10) || '| --- |' || repeat(' --- |', count(*) + 1) AS head,
    '| **Total** | ' || string_agg('**' || CAST(CAST(n AS BIGINT) AS VARCHAR) || '**', ' | ' ORDER BY c)
      || ' | **' || CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) || '** |' AS foot
  FROM {name}_cols GROUP BY run_id),
{name} AS (
  SELECT h.run_id, h.head || chr(10) || string_agg(l.line, chr(10) ORDER BY l.r) || chr(10) || h.foot AS markdown
  FROM {name}_heads h JOIN {name}_lines l ON h.run_id = l.run_id GROUP BY h.run_id, h.head, h.foot)"""


PIVOT_SETS = """SELECT run_id,
  CASE grouping(row_key) * 2 + grouping(col_key) WHEN 0 THEN 'cell' WHEN 1 THEN 'row_total'
    WHEN 2 THEN 'col_total' ELSE 'grand_total' END AS kind,
  row_key, col_key, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT run_id, coalesce(continuation, '(unknown)') AS row_key,
        coalesce({col}, '(unknown)') AS col_key, n FROM {source}) x
GROUP BY GROUPING SETS ((run_id, row_key, col_key), (run_id, row_key), (run_id, col_key), (run_id))"""


@query(
    "requests_by_status",
    ("requests",),
    "SELECT run_id, continuation, status, count(*) AS n FROM requests GROUP BY 1, 2, 3",
)
def _(t):
    return runs.requests_by_status(t("requests")).orderBy("run_id", "continuation", "status")


@query(
    "results_by_type",
    ("results",),
    f"WITH {TYPES} SELECT run_id, result_type, CAST(valid AS BIGINT) AS valid, "
    "CAST(invalid AS BIGINT) AS invalid FROM result_types",
)
def _(t):
    return runs.results_by_type(t("results")).orderBy("run_id", "result_type")


@query(
    "errors_total",
    ("runs", "errors"),
    """SELECT r.run_id, count(e.id) AS errors FROM runs r LEFT JOIN errors e ON r.run_id = e.run_id
GROUP BY r.run_id""",
)
def _(t):
    return runs.errors_total(t("errors"), t("runs"))


@query(
    "errors_by_type",
    ("errors",),
    "SELECT run_id, error_type, count(*) AS n FROM errors GROUP BY 1, 2",
)
def _(t):
    return runs.errors_by_type(t("errors"))


@query(
    "errors_detail_topk",
    ("errors",),
    f"""WITH {TOP} SELECT run_id, CAST(rank AS INTEGER) AS rank, id, error_type, error_class, message,
  request_url FROM top_errors""",
)
def _(t):
    return runs.errors_detail_topk(t("errors")).drop("request_id")


@query(
    "errors_by_continuation",
    ("requests", "errors"),
    f"WITH {STEPS} SELECT run_id, continuation, error_type, n FROM error_steps",
)
def _(t):
    return runs.errors_by_continuation(t("errors"), t("requests")).orderBy(
        "run_id", "continuation", "error_type"
    )


@query(
    "error_broadcast",
    ("errors",),
    """SELECT run_id, CAST(sum(n) AS BIGINT) AS errors,
  string_agg(error_type || '=' || CAST(n AS VARCHAR), ', ' ORDER BY error_type) AS by_type
FROM (SELECT run_id, error_type, count(*) AS n FROM errors GROUP BY 1, 2) x GROUP BY run_id""",
)
def _(t):
    return runs.error_broadcast(t("errors"))


@query(
    "pivot_counts",
    ("requests", "errors"),
    f"WITH {STEPS} " + PIVOT_SETS.format(col="error_type", source="error_steps"),
)
def _(t):
    steps = runs.errors_by_continuation(t("errors"), t("requests"))
    return runs.pivot_counts(steps, "continuation", "error_type")


@query(
    "pivot_requests",
    ("requests",),
    f"WITH {STATUS} " + PIVOT_SETS.format(col="status", source="requests_by_status"),
)
def _(t):
    return runs.pivot_counts(runs.requests_by_status(t("requests")), "continuation", "status")


@query(
    "pivot_wide",
    ("requests",),
    """SELECT run_id, coalesce(continuation, '(unknown)') AS row_key,
  count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'pending') AS pending,
  count(*) FILTER (status = 'in_progress') AS in_progress, count(*) FILTER (status = 'failed') AS failed,
  count(*) AS total
FROM requests GROUP BY 1, 2""",
)
def _(t):
    counts = runs.requests_by_status(t("requests"))
    return runs.pivot_wide(counts, "continuation", "status", schemas.REQUEST_STATUSES)


@query(
    "pivot_markdown",
    ("requests", "errors"),
    f"WITH {STEPS}, "
    + pivot_sql("pivoted", "error_steps", "continuation", "error_type", "Continuation", "Error type")
    + " SELECT run_id, markdown FROM pivoted",
)
def _(t):
    steps = runs.errors_by_continuation(t("errors"), t("requests"))
    tables = runs.pivot_markdown(steps, "continuation", "error_type", "Continuation", "Error type")
    return tables.select("run_id", "markdown")


@query(
    "requests_total",
    ("requests",),
    "SELECT run_id, count(*) AS requests FROM requests GROUP BY 1",
)
def _(t):
    return runs.requests_total(t("requests"))


@query(
    "results_total",
    ("results",),
    f"""WITH {TYPES} SELECT run_id,
  CAST(sum(coalesce(valid, 0) + coalesce(invalid, 0)) AS BIGINT) AS results FROM result_types GROUP BY 1""",
)
def _(t):
    return runs.results_total(t("results"))


@query(
    "run_outcome",
    ("runs", "errors"),
    """SELECT r.run_id, count(e.id) AS errors,
  CASE WHEN count(e.id) > 0 THEN 'completed with errors' ELSE 'completed' END AS outcome
FROM runs r LEFT JOIN errors e ON r.run_id = e.run_id WHERE NOT r.drained GROUP BY r.run_id""",
)
def _(t):
    return runs.run_outcome(t("runs"), t("errors"))


@query(
    "results_table_rows",
    ("results",),
    f"""WITH {TYPES} SELECT run_id, result_type, CAST(grouping(result_type) AS INTEGER) AS is_total,
  CAST(sum(coalesce(valid, 0)) AS BIGINT) AS valid, CAST(sum(coalesce(invalid, 0)) AS BIGINT) AS invalid,
  CAST(sum(coalesce(valid, 0) + coalesce(invalid, 0)) AS BIGINT) AS total
FROM result_types GROUP BY GROUPING SETS ((run_id, result_type), (run_id))""",
)
def _(t):
    return runs.results_table_rows(t("results"))


@query(
    "errors_truncation",
    ("runs", "errors"),
    """SELECT r.run_id, count(e.id) AS errors, least(count(e.id), 50) AS shown,
  greatest(count(e.id) - 50, 0) AS hidden
FROM runs r LEFT JOIN errors e ON r.run_id = e.run_id GROUP BY r.run_id""",
)
def _(t):
    return runs.errors_truncation(t("errors"), t("runs"))


@query(
    "error_text_clean",
    ("errors",),
    """SELECT run_id, id, replace(replace(coalesce(message, ''), '|', '\\|'), chr(10), ' ') AS message
FROM errors""",
)
def _(t):
    return t("errors").select("run_id", "id", text.error_text_clean(F.col("message")).alias("message"))


@query(
    "run_report",
    ("runs", "requests", "results", "errors"),
    f"""WITH {STATUS}, {STEPS}, {TYPES}, {TOP},
{pivot_sql("status_md", "requests_by_status", "continuation", "status", "Continuation", "Status")},
{pivot_sql("steps_md", "error_steps", "continuation", "error_type", "Continuation", "Error type")},
result_md AS (
  SELECT run_id, '| Type | Valid | Invalid | Total |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) ||
    string_agg('| ' || result_type || ' | ' || CAST(coalesce(valid, 0) AS BIGINT)::VARCHAR || ' | ' ||
      CAST(coalesce(invalid, 0) AS BIGINT)::VARCHAR || ' | ' ||
      CAST(coalesce(valid, 0) + coalesce(invalid, 0) AS BIGINT)::VARCHAR || ' |', chr(10) ORDER BY result_type)
    || chr(10) || '| **Total** | | | **' ||
    CAST(sum(coalesce(valid, 0) + coalesce(invalid, 0)) AS BIGINT)::VARCHAR || '** |' AS md,
    CAST(sum(coalesce(valid, 0) + coalesce(invalid, 0)) AS BIGINT) AS results
  FROM result_types GROUP BY run_id),
detail_md AS (
  SELECT run_id, '| Type | Class | Message | URL |' || chr(10) || '| --- | --- | --- | --- |' || chr(10) ||
    string_agg('| ' || error_type || ' | ' || error_class || ' | ' ||
      replace(replace(coalesce(message, ''), '|', '\\|'), chr(10), ' ') || ' | ' || request_url || ' |',
      chr(10) ORDER BY rank) AS md, count(*) AS shown
  FROM top_errors GROUP BY run_id),
counts AS (
  SELECT r.run_id, (SELECT count(*) FROM requests q WHERE q.run_id = r.run_id) AS requests,
    (SELECT count(*) FROM errors e WHERE e.run_id = r.run_id) AS errors FROM runs r)
SELECT r.run_id, '# Scrape ' || CASE WHEN k.errors > 0 THEN 'completed with errors' ELSE 'completed' END
  || chr(10) || chr(10) || '- **Scraper**: `' || r.source_path || '`' || chr(10)
  || '- **Schema**: `' || r.schema || '`' || chr(10) || '- **Database**: `' || r.uri || '`' || chr(10)
  || '- **Requests**: ' || k.requests::VARCHAR || chr(10)
  || '- **Results**: ' || coalesce(v.results, 0)::VARCHAR || chr(10)
  || '- **Errors**: ' || k.errors::VARCHAR || chr(10) || chr(10)
  || '## Requests by status and continuation' || chr(10) || chr(10)
  || coalesce(s.markdown, '_No requests recorded._') || chr(10) || chr(10)
  || '## Results by type' || chr(10) || chr(10) || coalesce(v.md, '_No results recorded._')
  || chr(10) || chr(10) || '## Errors by continuation and type' || chr(10) || chr(10)
  || CASE WHEN k.errors = 0 THEN '_No errors recorded._' ELSE p.markdown || chr(10) || chr(10)
     || '## Error detail' || chr(10) || chr(10) || d.md
     || CASE WHEN k.errors > d.shown THEN chr(10) || chr(10) || '_…and ' || (k.errors - d.shown)::VARCHAR
        || ' more (showing first ' || d.shown::VARCHAR || ')._' ELSE '' END END || chr(10) AS report
FROM runs r JOIN counts k ON k.run_id = r.run_id LEFT JOIN status_md s ON s.run_id = r.run_id
LEFT JOIN steps_md p ON p.run_id = r.run_id LEFT JOIN result_md v ON v.run_id = r.run_id
LEFT JOIN detail_md d ON d.run_id = r.run_id WHERE NOT r.drained""",
)
def _(t):
    return runs.run_report(t("runs"), t("requests"), t("results"), t("errors"))


SUMMARY = f"""WITH {STATUS}, {STEPS}, {TYPES}, {TOP}
SELECT r.run_id, coalesce(a.x, '') AS requests_by_status, coalesce(b.x, '') AS errors_by_continuation,
  coalesce(c.x, '') AS results_by_type, coalesce(b.total, 0) AS total, coalesce(d.x, '') AS by_type,
  coalesce(e.x, '') AS rows
FROM runs r
LEFT JOIN (SELECT run_id, string_agg(continuation || '/' || status || '=' || n::VARCHAR, '; '
    ORDER BY continuation, status) AS x FROM requests_by_status GROUP BY 1) a ON a.run_id = r.run_id
LEFT JOIN (SELECT run_id, string_agg(coalesce(continuation, '-') || '/' || error_type || '=' || n::VARCHAR,
    '; ' ORDER BY continuation NULLS FIRST, error_type) AS x, CAST(sum(n) AS BIGINT) AS total
    FROM error_steps GROUP BY 1) b ON b.run_id = r.run_id
LEFT JOIN (SELECT run_id, string_agg(result_type || '=' || coalesce(CAST(valid AS BIGINT)::VARCHAR, '-') || '+' ||
    CAST(invalid AS BIGINT)::VARCHAR, '; ' ORDER BY result_type) AS x FROM result_types GROUP BY 1) c
  ON c.run_id = r.run_id
LEFT JOIN (SELECT run_id, string_agg(error_type || '=' || n::VARCHAR, '; ' ORDER BY error_type) AS x
    FROM (SELECT run_id, error_type, count(*) AS n FROM errors GROUP BY 1, 2) y GROUP BY 1) d
  ON d.run_id = r.run_id
LEFT JOIN (SELECT run_id, string_agg(error_type || ' ' || error_class || ' ' || coalesce(message, '-') || ' ' ||
    request_url, '; ' ORDER BY rank) AS x FROM top_errors GROUP BY 1) e ON e.run_id = r.run_id"""


@query("run_summary", ("runs", "requests", "results", "errors"), SUMMARY)
def _(t):
    return printed_summary(runs.run_summary(t("runs"), t("requests"), t("results"), t("errors")))


def printed_summary(summary):
    """The nested summary, printed as text so that both sides can be compared."""

    def printed(name, show):
        return F.array_join(F.transform(name, show), "; ").alias(name)

    def dash(value):
        return F.coalesce(value.cast("string"), F.lit("-"))

    return summary.select(
        "run_id",
        printed(
            "requests_by_status",
            lambda x: F.concat(x["continuation"], F.lit("/"), x["status"], F.lit("="), dash(x["n"])),
        ),
        printed(
            "errors_by_continuation",
            lambda x: F.concat(
                dash(x["continuation"]), F.lit("/"), x["error_type"], F.lit("="), dash(x["n"])
            ),
        ),
        printed(
            "results_by_type",
            lambda x: F.concat(
                x["result_type"], F.lit("="), dash(x["valid"]), F.lit("+"), dash(x["invalid"])
            ),
        ),
        "total",
        F.array_join(
            F.transform(
                F.map_entries("by_type"), lambda x: F.concat(x["key"], F.lit("="), dash(x["value"]))
            ),
            "; ",
        ).alias("by_type"),
        printed(
            "rows",
            lambda x: F.concat_ws(
                " ", x["error_type"], x["error_class"], dash(x["message"]), x["request_url"]
            ),
        ),
    )


@query(
    "optional_table",
    ("runs", "requests", "results", "errors"),
    SUMMARY.replace("FROM results", "FROM (SELECT * FROM results WHERE false) none_yet"),
)
def _(t):
    """The summary of runs whose results table does not exist: their other parts are there."""
    absent = optional_table(t.spark, f"{t.folder}/absent_results.parquet", schemas.RESULTS)
    return printed_summary(runs.run_summary(t("runs"), t("requests"), absent, t("errors")))


PROGRESS_COUNTS = """count(*) AS total, count(*) FILTER (status = 'completed') AS completed,
  count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'in_progress') AS in_progress,
  count(*) FILTER (status = 'failed') AS failed"""


STATUS_OF = """CASE WHEN {total} = {pending} THEN 'waiting' WHEN {pending} + {in_progress} > 0 THEN 'running' ELSE 'settled' END"""


RATE_DIGITS = 9


def rounded_rate(snapshots):
    return snapshots.withColumn("requests_per_minute", F.round("requests_per_minute", RATE_DIGITS))


@query(
    "progress_snapshot",
    ("runs", "requests", "results", "errors"),
    f"""WITH q AS (SELECT run_id, {PROGRESS_COUNTS},
    max(ts) FILTER (status = 'completed') AS last_ts, min(ts) FILTER (status = 'completed') AS first_ts
  FROM requests GROUP BY 1),
v AS (SELECT run_id, count(*) AS results, count(*) FILTER (is_valid <> 0) AS valid FROM results GROUP BY 1),
e AS (SELECT run_id, count(*) AS errors FROM errors GROUP BY 1)
SELECT r.run_id, coalesce(total, 0) AS total, coalesce(completed, 0) AS completed,
  coalesce(pending, 0) AS pending, coalesce(in_progress, 0) AS in_progress, coalesce(failed, 0) AS failed,
  coalesce(results, 0) AS results, coalesce(valid, 0) AS valid,
  coalesce(results, 0) - coalesce(valid, 0) AS invalid, coalesce(errors, 0) AS errors,
  {STATUS_OF.format(total="coalesce(total, 0)", pending="coalesce(pending, 0)", in_progress="coalesce(in_progress, 0)")} AS status,
  round(completed / nullif((epoch_us(last_ts) - epoch_us(first_ts)) / 60000000.0, 0), 9) AS requests_per_minute
FROM runs r LEFT JOIN q ON q.run_id = r.run_id LEFT JOIN v ON v.run_id = r.run_id
LEFT JOIN e ON e.run_id = r.run_id""",
)
def _(t):
    snapshot = progress.progress_snapshot(t("runs"), t("requests"), t("results"), t("errors"))
    return rounded_rate(snapshot)


@query(
    "throughput_per_minute",
    ("requests",),
    """SELECT run_id, count(*) AS completed, round(count(*) /
  nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000.0, 0), 9) AS requests_per_minute
FROM requests WHERE status = 'completed' GROUP BY 1""",
)
def _(t):
    rate = progress.throughput_per_minute(t("requests"))
    return rate.withColumn("requests_per_minute", F.round("requests_per_minute", 9))


PROGRESS_TABLES = ("requests", "timed_results", "timed_errors")
PROGRESS_WINDOWS = f"""WITH a AS (
  SELECT run_id, ts, 'request' AS kind, status FROM requests
  UNION ALL SELECT run_id, ts, CASE WHEN is_valid <> 0 THEN 'valid' ELSE 'invalid' END, NULL FROM timed_results
  UNION ALL SELECT run_id, ts, 'error', NULL FROM timed_errors),
w AS (
  SELECT run_id, time_bucket(INTERVAL '300 seconds', ts) + INTERVAL '300 seconds' AS snapshot_at,
    {PROGRESS_COUNTS.replace("count(*) AS total", "count(*) FILTER (kind = 'request') AS total")},
    count(*) FILTER (kind IN ('valid', 'invalid')) AS results, count(*) FILTER (kind = 'valid') AS valid,
    count(*) FILTER (kind = 'invalid') AS invalid, count(*) FILTER (kind = 'error') AS errors,
    min(epoch_us(ts)) FILTER (status = 'completed') AS first_us, max(epoch_us(ts)) FILTER (status = 'completed') AS last_us
  FROM a GROUP BY 1, 2),
g AS (SELECT run_id, unnest(generate_series(min(snapshot_at), max(snapshot_at), INTERVAL 300 SECONDS)) AS snapshot_at
  FROM w GROUP BY 1),
f AS (SELECT g.run_id, g.snapshot_at, CAST(coalesce(completed, 0) AS BIGINT) AS completed_in_interval,
    {", ".join(f"CAST(sum(coalesce({c}, 0)) OVER s AS BIGINT) AS {c}_" for c in progress.COUNTS)},
    min(first_us) OVER s AS first_us, max(last_us) OVER s AS last_us
  FROM g LEFT JOIN w ON w.run_id IS NOT DISTINCT FROM g.run_id AND w.snapshot_at = g.snapshot_at
  WINDOW s AS (PARTITION BY g.run_id ORDER BY g.snapshot_at))
SELECT run_id, snapshot_at, {STATUS_OF.format(total="total_", pending="pending_", in_progress="in_progress_")} AS status, completed_in_interval,
  {", ".join(f"{c}_ AS {c}" for c in progress.COUNTS)},
  round(completed_ / nullif((last_us - first_us) / 60000000.0, 0), 9) AS requests_per_minute
FROM f"""


@query("progress_windows", PROGRESS_TABLES, PROGRESS_WINDOWS)
def _(t):
    return progress.progress_windows(*t(*PROGRESS_TABLES), digits=RATE_DIGITS)
