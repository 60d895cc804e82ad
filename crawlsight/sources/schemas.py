"""Explicit input schemas. Nothing is inferred except from Parquet footers."""

from __future__ import annotations

REQUESTS = "run_id string, id bigint, continuation string, status string, ts timestamp"
RESULTS = "run_id string, id bigint, result_type string, is_valid int"
ERRORS = (
    "run_id string, id bigint, request_id bigint, error_type string, "
    "error_class string, message string, request_url string"
)
RUNS = "run_id string, source_path string, schema string, uri string, drained boolean"
DOWNLOADS = (
    "prefix string, url string, deduplication_key string, expected_type string, "
    "content string, seq bigint"
)
POINTERS = "prefix string, dedup_sha string, file_url string"
OBJECTS = "content_key string, size bigint, first_seq bigint"
SOURCES = (
    "path string, module string, class_name string, defined_in string, "
    "requirements array<string>, court_ids array<string>"
)
FLOW_RUNS = (
    "run_id bigint, run_name string, attempt bigint, queue string, scheduled_at timestamp, "
    "started_at timestamp, ended_at timestamp, state string"
)
QUEUES = "queue string, concurrency_limit bigint, is_paused boolean"
SPANS = (
    "span_id bigint, trace_id bigint, parent_id bigint, name string, start_at timestamp, "
    "seconds double, backend string, scraper string, step string, run_id string"
)
METRICS = (
    "ts timestamp, metric string, value double, run_id string, scraper string, pool string, "
    "run_pool string, max_workers string, step string, phase string, kind string"
)
EVENTS = "event_id bigint, ts timestamp, resource bigint, event string, props string"

# The request states a run can be in.
REQUEST_STATUSES = ("completed", "pending", "in_progress", "failed")
