"""Input tables of the operators, derived from the driver's Parquet tables.

Each derivation is one SELECT that reads the same in Spark and in DuckDB, so the
SQL check starts from equal input. A third of the rows falls to one run, queue
or resource on purpose: that is the skew the operators have to survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import placed, read_table

_HOT_USER = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"
_TRACE = "CAST(floor(event_id / 5) AS BIGINT)"
_TRACE_RUN = f"CASE WHEN {_TRACE} % 3 = 0 THEN 0 ELSE CAST(floor(event_id / 65) AS BIGINT) END"

# name -> (tables read, SQL); braces name the tables.
DERIVATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "requests": (
        ("events",),
        f"""
SELECT 'run-' || CAST({_HOT_USER} AS STRING) AS run_id, event_id AS id,
  event_type AS continuation,
  CASE WHEN value < 2 THEN 'pending' WHEN value < 4 THEN 'in_progress'
       WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
  CAST(ts AS TIMESTAMP) AS ts
FROM {{events}}""",
    ),
    "errors": (
        ("events",),
        f"""
SELECT 'run-' || CAST({_HOT_USER} AS STRING) AS run_id, event_id AS id,
  CASE WHEN value < 5 THEN NULL WHEN value > 150 THEN -1 - event_id ELSE event_id END AS request_id,
  CASE WHEN event_id % 3 = 0 THEN 'http' WHEN event_id % 3 = 1 THEN 'structural'
       ELSE 'validation' END AS error_type,
  CASE WHEN value > 100 THEN 'Timeout' ELSE 'Mismatch' END AS error_class,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'a|b' || chr(10) || props END AS message,
  'https://example.org/e/' || CAST(event_id AS STRING) AS request_url
FROM {{events}} WHERE event_type = 'error' OR value > 150""",
    ),
    "results": (
        ("documents", "labels"),
        """
SELECT 'run-' || CAST(CASE WHEN d.doc_id % 3 = 0 THEN 0
         ELSE CAST(floor(d.doc_id / 10) AS BIGINT) END AS STRING) AS run_id,
  d.doc_id AS id, d.source AS result_type, l.quality AS is_valid
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    ),
    # Results and errors with the time at which they came in, for snapshots along time.
    "timed_results": (
        ("events",),
        f"""
SELECT 'run-' || CAST({_HOT_USER} AS STRING) AS run_id, event_id AS id,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN value > 20 THEN 1 ELSE 0 END AS is_valid, CAST(ts AS TIMESTAMP) AS ts
FROM {{events}} WHERE event_id % 4 <> 0""",
    ),
    "timed_errors": (
        ("events",),
        f"""
SELECT 'run-' || CAST({_HOT_USER} AS STRING) AS run_id, event_id AS id, CAST(ts AS TIMESTAMP) AS ts
FROM {{events}} WHERE event_type = 'error' OR value > 150""",
    ),
    "runs": (
        ("events",),
        f"""
SELECT 'run-' || CAST(u AS STRING) AS run_id,
  'crawl.sites.s' || CAST(u AS STRING) || ':Site' || CAST(u AS STRING) || 'Scraper' AS source_path,
  'site' || CAST(u AS STRING) AS schema,
  's3://scrapes/scraper_runs/site' || CAST(u AS STRING) || '/run-' || CAST(u AS STRING) || '.db' AS uri,
  top < 200 AS drained
FROM (SELECT {_HOT_USER} AS u, max(value) AS top FROM {{events}} GROUP BY 1) x""",
    ),
    "downloads": (
        ("documents", "pages"),
        """
SELECT lang || '/' AS prefix,
  'https://files.example.org/' || source || '/' || CAST(doc_id AS STRING) ||
    CASE WHEN doc_id % 3 = 0 THEN '.PDF?v=1' WHEN doc_id % 3 = 1 THEN '' ELSE '.tar.gz' END AS url,
  CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN ''
       ELSE 'k-' || CAST(CAST(floor(doc_id / 10) AS BIGINT) AS STRING) END AS deduplication_key,
  CASE WHEN doc_id % 2 = 0 THEN 'PDF' ELSE NULL END AS expected_type,
  text AS content, doc_id AS seq /* place */
FROM {documents}
UNION ALL
SELECT 'pages/' AS prefix, url, url AS deduplication_key, 'html' AS expected_type,
  html AS content, -1 - page_id AS seq /* place */
FROM {pages}""",
    ),
    # What earlier crawls stored: the labelled documents.
    "stored": (
        ("downloads", "labels"),
        """
SELECT w.prefix, w.url, w.deduplication_key, w.expected_type, w.content, w.seq
FROM {downloads} w JOIN {labels} l ON w.seq = l.doc_id""",
    ),
    "flow_runs": (
        ("orders",),
        """
SELECT run_id, run_name, attempt, queue, scheduled_at,
  CASE WHEN state = 'SCHEDULED' THEN NULL ELSE scheduled_at + wait * INTERVAL '1' MINUTE END AS started_at,
  CASE WHEN state IN ('SCHEDULED', 'RUNNING') THEN NULL
       ELSE scheduled_at + (wait + busy) * INTERVAL '1' MINUTE END AS ended_at,
  state
FROM (
  SELECT o_orderkey AS run_id,
    'r-' || CAST(CAST(floor(o_orderkey / 3) AS BIGINT) AS STRING) AS run_name,
    o_orderkey % 3 AS attempt,
    'queue-' || CAST(CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS STRING) AS queue,
    CAST(o_orderdate AS TIMESTAMP) AS scheduled_at,
    o_orderkey % 120 AS wait, o_custkey % 2880 AS busy,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'RUNNING'
         WHEN o_orderstatus = 'O' THEN 'SCHEDULED'
         WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'FAILED'
         WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE 'CANCELLED' END AS state
  FROM {orders}) x""",
    ),
    "queues": (
        ("customer",),
        """
SELECT 'queue-' || CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END AS STRING) AS queue,
  CAST(max(1 + c_custkey % 4) AS BIGINT) AS concurrency_limit,
  max(c_acctbal) < 0 AS is_paused
FROM {customer} GROUP BY 1""",
    ),
    # Five events make one trace. Lookup hangs under the request, the other two
    # archive phases under transport.resolve.
    "spans": (
        ("events",),
        f"""
SELECT event_id AS span_id, {_TRACE} AS trace_id,
  CASE WHEN event_id % 5 = 0 THEN NULL
       WHEN event_id % 5 = 4 AND {_TRACE} % 3 > 0 THEN event_id - 2
       ELSE event_id - event_id % 5 END AS parent_id,
  CASE WHEN event_id % 5 = 0 THEN 'request' WHEN event_id % 5 = 1 THEN 'rate_limiter.gate'
       WHEN event_id % 5 = 2 THEN 'transport.resolve' WHEN event_id % 5 = 3 THEN 'continuation'
       WHEN {_TRACE} % 3 = 0 THEN 'archive.lookup'
       WHEN {_TRACE} % 3 = 1 THEN 'archive.download' ELSE 'archive.upload' END AS name,
  CAST(ts AS TIMESTAMP) AS start_at, value / 1000 AS seconds,
  CASE WHEN {_TRACE} % 2 = 0 THEN 's3' ELSE 'local' END AS backend,
  'site' || CAST({_TRACE_RUN} AS STRING) AS scraper,
  CASE WHEN {_TRACE} % 4 = 0 THEN 'listing' WHEN {_TRACE} % 4 = 1 THEN 'detail'
       WHEN {_TRACE} % 4 = 2 THEN 'search' ELSE 'download' END AS step,
  CASE WHEN {_TRACE} % 11 = 0 THEN NULL
       ELSE 'run-' || CAST({_TRACE_RUN} AS STRING) END AS run_id
FROM {{events}}""",
    ),
    "metrics": (
        ("events",),
        f"""
SELECT CAST(ts AS TIMESTAMP) AS ts,
  CASE WHEN event_id % 10 = 0 THEN 'event_loop.lag' WHEN event_id % 10 = 1 THEN 'request.duration'
    WHEN event_id % 10 = 2 THEN 'request.cpu_time' WHEN event_id % 10 = 3 THEN 'db.lock.wait'
    WHEN event_id % 10 = 4 THEN 'db.lock.hold' WHEN event_id % 10 = 5 THEN 'compression.duration'
    WHEN event_id % 10 = 6 THEN 'compression.ratio' WHEN event_id % 10 = 7 THEN 'compaction.duration'
    WHEN event_id % 10 = 8 THEN 'worker.active' ELSE 'queue.pending' END AS metric,
  value / 1000 AS value,
  'run-' || CAST({_HOT_USER} AS STRING) AS run_id,
  'site' || CAST({_HOT_USER} AS STRING) AS scraper,
  CASE WHEN user_id % 4 = 0 THEN 'browser-pool' ELSE 'scraper-pool' END AS pool,
  CASE WHEN user_id % 3 = 0 THEN 'runloop' WHEN user_id % 3 = 1 THEN 'thread' ELSE 'process' END AS run_pool,
  CASE WHEN user_id % 5 = 0 THEN '' WHEN user_id % 5 = 4 THEN NULL
       WHEN user_id % 5 < 3 THEN '10' ELSE '20' END AS max_workers,
  CASE WHEN event_id % 10 IN (0, 8, 9) OR event_id % 10 IN (3, 4) AND event_id % 7 = 0 THEN NULL
       ELSE event_type END AS step,
  CASE WHEN event_id % 10 = 1 AND value < 20 THEN 'total' WHEN event_id % 10 = 1 AND value < 40 THEN 'rate_limiter.gate'
       WHEN event_id % 10 = 1 AND value < 80 THEN 'transport.resolve' WHEN event_id % 10 = 1 THEN 'continuation'
       WHEN event_id % 10 = 2 AND event_id % 3 = 0 THEN 'compress' WHEN event_id % 10 = 2 AND event_id % 3 = 1
       THEN 'continuation' WHEN event_id % 10 = 2 THEN 'parse' END AS phase,
  CASE WHEN event_id % 10 IN (5, 7) AND event_id % 4 = 1 THEN 'train' WHEN event_id % 10 IN (5, 7) THEN 'recompress' END
    AS kind
FROM {{events}}""",
    ),
    "trigger_events": (
        ("events",),
        f"""
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, {_HOT_USER} AS resource, event_type AS event, props
FROM {{events}}""",
    ),
    # Events with several labels, some without one of them.
    "labelled_events": (
        ("events",),
        """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type AS event,
  CASE WHEN event_id % 13 = 0 THEN props ELSE replace(props, '}}', ', "site": "' ||
    CASE WHEN user_id % 3 = 0 THEN 'court-0' WHEN user_id % 7 = 0 THEN 'blog' ELSE 'court-' || CAST(user_id % 9 AS STRING) END
    || '", "kind": "' || event_type || '"}}') END AS props
FROM {events}""",
    ),
    # Requests to start a run, some with seeds, some with an empty list, some without.
    "seeds": (
        ("events",),
        f"""
SELECT event_id AS request_no, 'run-' || CAST({_HOT_USER} AS STRING) AS run_id,
  CASE WHEN value < 5 THEN NULL WHEN value < 10 THEN '[]'
       ELSE '[{{{{"' || event_type || '":' || replace(props, ' ', '') || ',"retry":{{{{}}}}}}}},{{{{"' || event_type || '":{{{{}}}}}}}}]'
       END AS seed_params
FROM {{events}}""",
    ),
    "submissions": (
        ("part",),
        """
SELECT p_partkey AS submission,
  CASE WHEN p_size = 10 THEN 'crawl.' || lower(p_type) WHEN p_size = 11 THEN 'crawl.' || lower(p_type) || ':'
       WHEN p_size = 12 THEN '' WHEN p_size = 13 THEN NULL
       ELSE 'crawl.' || lower(p_type) || ':Part' || CAST(p_partkey AS STRING) || 'Scraper' END AS scraper_path,
  CASE WHEN p_size = 14 THEN '' WHEN p_size = 15 THEN NULL
       ELSE 'part' || CAST(p_partkey AS STRING) END AS scraper_schema
FROM {part}""",
    ),
    # One interval schedule per queue, anchored at its first run; every other queue has a slower one beside it.
    "schedules": (
        ("flow_runs",),
        """
SELECT queue, CAST(queue AS STRING) || '/often' AS schedule_id, min(scheduled_at) AS anchor,
  CAST(86400 * (20 + count(*) % 10) AS BIGINT) AS interval_seconds, CAST(40 + max(run_id) % 60 AS BIGINT) AS max_scheduled_runs
FROM {flow_runs} GROUP BY queue
UNION ALL
SELECT queue, CAST(queue AS STRING) || '/seldom' AS schedule_id, min(scheduled_at) AS anchor,
  CAST(86400 * 5 * (20 + count(*) % 10) AS BIGINT) AS interval_seconds, CAST(40 + max(run_id) % 60 AS BIGINT) AS max_scheduled_runs
FROM {flow_runs} GROUP BY queue HAVING count(*) % 2 = 0""",
    ),
    # Class names are put together from the part names; some modules are tests,
    # some classes are re-exports, some need a browser.
    "sources": (
        ("part", "lineitem", "supplier", "nation"),
        """
SELECT module || ':' || class_name AS path, module, class_name,
  CASE WHEN p_size = 5 THEN 'crawl.base' ELSE module END AS defined_in,
  CASE WHEN p_size % 7 = 0 THEN 'JS_EVAL,LOGIN' WHEN p_size % 7 = 1 THEN 'FF_ALIKE'
       WHEN p_size % 7 = 2 THEN 'LOGIN' ELSE NULL END AS requirements_text,
  courts_text
FROM (
  SELECT p_partkey, p_size,
    'crawl.' || lower(p_type) || CASE WHEN p_size = 1 THEN '.tests' WHEN p_size = 2 THEN '.test_sites'
      WHEN p_size = 3 THEN '.conftest' WHEN p_size = 4 THEN '.contest' ELSE '.sites' END
      || '.' || lower(replace(p_brand, '#', '_')) AS module,
    CASE WHEN p_partkey % 5 = 0 THEN 'Registry.' ELSE '' END ||
    CASE WHEN p_partkey % 4 = 0 THEN 'NY' WHEN p_partkey % 4 = 1 THEN '_HTTP2' ELSE '' END ||
    upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) ||
    CASE WHEN p_size % 2 = 0 THEN '_' ELSE '' END ||
    upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) ||
    CAST(CAST(floor(p_partkey / 8) AS BIGINT) AS STRING) ||
    CASE WHEN p_size % 3 = 0 THEN '' ELSE 'Scraper' END AS class_name
  FROM {part}) p
LEFT JOIN (
  SELECT l_partkey, string_agg(DISTINCT lower(n_name), ',') AS courts_text
  FROM {lineitem}
  JOIN {supplier} ON l_suppkey = s_suppkey
  JOIN {nation} ON s_nationkey = n_nationkey
  WHERE l_returnflag = 'R' AND l_quantity > 35
  GROUP BY l_partkey) c ON p_partkey = l_partkey""",
    ),
}


def derive(spark: SparkSession, folder: str, name: str, read=read_table) -> DataFrame:
    """A derived table, or one of the driver's own tables where ``name`` is not derived.

    ``read`` may open streams instead of tables.
    """
    if name not in DERIVATIONS:
        return read(spark, folder, name)
    inputs, sql = DERIVATIONS[name]
    table = spark.sql(sql, **{each: derive(spark, folder, each, read) for each in inputs})
    if name == "sources":
        table = table.selectExpr(
            "path",
            "module",
            "class_name",
            "defined_in",
            "split(requirements_text, ',') AS requirements",
            "filter(split(courts_text, ','), x -> x <> '') AS court_ids",
        )
    return table


def placed_downloads(spark: SparkSession, folder: str) -> DataFrame:
    """The derived downloads, each with its file and row."""
    inputs, sql = DERIVATIONS["downloads"]
    tables = {each: placed(read_table(spark, folder, each)) for each in inputs}
    return spark.sql(sql.replace("/* place */", ", file_path, row_index"), **tables)


def with_sql(*names: str) -> str:
    """The WITH clause that gives a SQL check the derived tables ``names``."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done or name not in DERIVATIONS:
            return
        inputs, sql = DERIVATIONS[name]
        for each in inputs:
            add(each)
        done[name] = f"{name} AS ({sql.format(**{each: each for each in inputs})}\n)"

    for name in names:
        add(name)
    return "WITH " + ",\n".join(done.values()) + "\n"
