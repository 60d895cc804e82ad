"""Archive queries over the derived downloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import archive
from ..session import delete_dir, fresh_dir
from ..sources.derive import placed_downloads
from ..sources.tables import list_objects, publish_runs, read_runs
from .registry import query

EXTENSION = """lower(regexp_extract(regexp_extract(regexp_replace(regexp_replace(regexp_extract({url},
    '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '/+$', ''),
    '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1))"""


def keyed_sql(name: str, source: str) -> str:
    """CTEs with the archive keys of a downloads table."""
    types = " ".join(f"WHEN '{kind}' THEN '{ext}'" for kind, ext in keys.TYPE_EXTENSIONS.items())
    return f"""{name}_ext AS (
  SELECT *, {EXTENSION.format(url="url")} AS suffix FROM {source}),
{name}_sha AS (
  SELECT *, sha256(content) AS sha, CASE WHEN suffix <> '' THEN suffix
    ELSE coalesce(CASE lower(expected_type) {types} END, '') END AS ext,
    CASE WHEN coalesce(deduplication_key, '') <> '' THEN sha256(deduplication_key) END AS dedup_sha
  FROM {name}_ext),
{name} AS (
  SELECT *, prefix || substr(sha, 1, 2) || '/' || substr(sha, 3, 2) || '/' || sha || ext AS content_key,
    CAST(strlen(content) AS BIGINT) AS size FROM {name}_sha)"""


KEYED = keyed_sql("keyed", "downloads")
STORED = keyed_sql("stored_keyed", "stored")
POINTERS = """{name} AS (
  SELECT prefix, dedup_sha, arg_max('s3://files/' || content_key, seq) AS file_url
  FROM {source} WHERE dedup_sha IS NOT NULL GROUP BY 1, 2)"""
OLD_POINTERS = POINTERS.format(name="pointers", source="stored_keyed")
NEW_POINTERS = POINTERS.format(name="new_pointers", source="keyed")
OBJECTS = """{name} AS (
  SELECT content_key, max(size) AS size, min(seq) AS first_seq FROM {source} GROUP BY 1)"""
TABLES = ("downloads", "stored")


@query(
    "content_key",
    ("downloads",),
    f"WITH {KEYED} SELECT seq, url, content_key, size FROM keyed",
)
def _(t):
    return archive.with_keys(t("downloads")).select("seq", "url", "content_key", "size")


@query(
    "file_extension",
    ("downloads",),
    f"WITH {KEYED} SELECT seq, url, ext FROM keyed",
)
def _(t):
    ext = keys.file_extension(F.col("url"), F.col("expected_type"))
    return t("downloads").select("seq", "url", ext.alias("ext"))


@query(
    "dedup_pointer_key",
    ("downloads",),
    """SELECT seq, prefix || '_dedup/' || sha256(deduplication_key) AS pointer_key
FROM downloads WHERE coalesce(deduplication_key, '') <> ''""",
)
def _(t):
    keyed = t("downloads").where(keys.has_key(F.col("deduplication_key")))
    return keyed.select(
        "seq",
        keys.dedup_pointer_key(F.col("prefix"), F.col("deduplication_key")).alias("pointer_key"),
    )


@query(
    "download_plan",
    TABLES,
    f"""WITH {STORED}, {OLD_POINTERS}, {KEYED}
SELECT k.prefix, k.url, k.seq, p.file_url IS NULL AS download, p.file_url
FROM keyed k LEFT JOIN pointers p ON k.prefix = p.prefix AND k.dedup_sha = p.dedup_sha""",
)
def _(t):
    return archive.download_plan(t("downloads"), archive.pointers_of(t("stored")))


@query(
    "downloads_needed",
    TABLES,
    f"""WITH {STORED}, {OLD_POINTERS}, {KEYED} SELECT prefix, url, seq FROM keyed k
WHERE NOT EXISTS (SELECT 1 FROM pointers p WHERE k.prefix = p.prefix AND k.dedup_sha = p.dedup_sha)""",
)
def _(t):
    return archive.downloads_needed(t("downloads"), archive.pointers_of(t("stored")))


@query(
    "downloads_skipped",
    TABLES,
    f"""WITH {STORED}, {OLD_POINTERS}, {KEYED} SELECT prefix, url, seq FROM keyed k
WHERE EXISTS (SELECT 1 FROM pointers p WHERE k.prefix = p.prefix AND k.dedup_sha = p.dedup_sha)""",
)
def _(t):
    return archive.downloads_skipped(t("downloads"), archive.pointers_of(t("stored")))


@query(
    "content_upsert",
    TABLES,
    f"""WITH {STORED}, {KEYED}, {OBJECTS.format(name="objects", source="keyed")}
SELECT * FROM objects WHERE content_key NOT IN (SELECT content_key FROM stored_keyed)""",
)
def _(t):
    return archive.content_upsert(t("downloads"), archive.objects_of(t("stored")))


@query(
    "content_to_write",
    TABLES,
    f"""WITH {STORED}, {KEYED}, {OBJECTS.format(name="objects", source="keyed")}
SELECT o.content_key, o.size, o.first_seq, md5(d.content) AS content_md5
FROM objects o JOIN downloads d ON d.seq = o.first_seq
WHERE o.content_key NOT IN (SELECT content_key FROM stored_keyed)""",
)
def _(t):
    # The derived table "stored", hashed before it meets the labels, so that its bytes are not joined either.
    keyed = archive.with_keys(t("downloads")).select("content_key", "size", "seq")
    stored = keyed.join(t("labels").select(F.col("doc_id").alias("seq")), "seq", "left_semi")
    rows = archive.content_by_place(placed_downloads(t.spark, t.folder), archive.keyed_objects(stored))
    return rows.select("content_key", "size", "first_seq", F.md5("content").alias("content_md5"))


@query(
    "pointer_upsert",
    TABLES,
    f"""WITH {STORED}, {OLD_POINTERS}, {KEYED}, {NEW_POINTERS}
SELECT prefix, dedup_sha, file_url FROM new_pointers
UNION ALL SELECT prefix, dedup_sha, file_url FROM pointers
WHERE (prefix, dedup_sha) NOT IN (SELECT (prefix, dedup_sha) FROM new_pointers)""",
)
def _(t):
    return archive.pointer_upsert(t("downloads"), archive.pointers_of(t("stored")))


@query(
    "archive_savings",
    ("downloads",),
    f"""WITH {KEYED}, one AS (
  SELECT prefix, content_key, count(*) AS copies, max(size) AS size FROM keyed GROUP BY 1, 2)
SELECT prefix, CAST(sum(copies) AS BIGINT) AS downloads, count(*) AS objects,
  CAST(sum(size * copies) AS BIGINT) AS bytes, CAST(sum(size) AS BIGINT) AS stored_bytes
FROM one GROUP BY 1""",
)
def _(t):
    return archive.archive_savings(t("downloads"))


@query(
    "shard_histogram",
    ("downloads",),
    f"""WITH {KEYED} SELECT prefix, substr(sha, 1, 2) AS shard, count(DISTINCT content_key) AS objects
FROM keyed GROUP BY 1, 2""",
)
def _(t):
    return archive.shard_histogram(t("downloads"))


# The listing holds what the first crawl stored, with some sizes cut short, and
# files of another layout that no manifest knows.
LISTING = f"""{OBJECTS.format(name="stored_objects", source="stored_keyed")},
listing AS (
  SELECT content_key AS path, CASE WHEN first_seq % 10 = 3 THEN size - 1 ELSE size END AS size FROM stored_objects
  UNION ALL SELECT 'old/' || content_key, size FROM stored_objects)"""


def listing(t):
    objects = archive.objects_of(t("stored"))
    cut = F.when(F.col("first_seq") % 10 == 3, F.col("size") - 1).otherwise(F.col("size"))
    old = objects.select(F.concat(F.lit("old/"), F.col("content_key")).alias("path"), "size")
    return objects.select(F.col("content_key").alias("path"), cut.alias("size")).unionByName(old)


@query(
    "archive_verify",
    TABLES,
    f"""WITH {STORED}, {KEYED}, {OBJECTS.format(name="objects", source="keyed")}, {LISTING}
SELECT coalesce(o.content_key, l.path) AS path, o.size AS expected_size, l.size AS stored_size,
  CASE WHEN l.size IS NULL THEN 'missing' WHEN o.size IS NULL THEN 'unexpected'
    WHEN l.size <> o.size THEN 'size_mismatch' ELSE 'ok' END AS status
FROM objects o FULL OUTER JOIN listing l ON o.content_key = l.path""",
)
def _(t):
    manifest = archive.objects_of(t("downloads")).withColumnRenamed("content_key", "path")
    return archive.archive_verify(manifest, listing(t))


@query(
    "archive_verify_listing",
    ("downloads",),
    f"WITH {KEYED} SELECT min(substr(sha, 1, 2)) AS shard, 'missing' AS status FROM keyed",
)
def _(t):
    """An archive is written, listed, and loses its first shard; the files that are listed again show which."""
    objects = archive.objects_of(t("downloads"))
    root = fresh_dir(t.spark, "archive-objects")
    shard = archive.shard_of(F.col("content_key")).alias("shard")
    objects.select("*", shard).repartition("shard").write.partitionBy("shard").parquet(f"{root}/objects")
    list_objects(t.spark, f"{root}/objects").write.parquet(f"{root}/manifest")
    manifest = t.spark.read.schema("path string, size long").parquet(f"{root}/manifest")
    lost = objects.agg(F.min(shard)).first()[0]
    delete_dir(t.spark, f"{root}/objects/shard={lost}")
    found = archive.archive_differences(manifest, list_objects(t.spark, f"{root}/objects"))
    return found.select(F.regexp_extract("path", "shard=([0-9a-f]{2})", 1).alias("shard"), "status").distinct()


@query(
    "dangling_pointers",
    TABLES,
    f"""WITH {STORED}, {KEYED}, {NEW_POINTERS} SELECT prefix, dedup_sha, file_url FROM new_pointers
WHERE file_url NOT IN (SELECT 's3://files/' || content_key FROM stored_keyed)""",
)
def _(t):
    return archive.dangling_pointers(
        archive.pointers_of(t("downloads")), archive.objects_of(t("stored"))
    )


@query(
    "integrity_check",
    ("requests", "results", "errors"),
    """WITH ids AS (SELECT run_id, id, count(*) AS copies FROM requests GROUP BY 1, 2)
SELECT run_id, 'duplicate request id' AS issue, CAST(sum(copies - 1) AS BIGINT) AS n FROM ids
  WHERE copies > 1 GROUP BY 1
UNION ALL SELECT run_id, 'request without key', count(*) FROM requests
  WHERE run_id IS NULL OR id IS NULL GROUP BY 1
UNION ALL SELECT run_id, 'unknown request status', count(*) FROM requests
  WHERE status IS NULL OR status NOT IN ('completed', 'pending', 'in_progress', 'failed') GROUP BY 1
UNION ALL SELECT run_id, 'result without key', count(*) FROM results WHERE run_id IS NULL OR id IS NULL GROUP BY 1
UNION ALL SELECT run_id, 'result flag not 0 or 1', count(*) FROM results WHERE is_valid NOT IN (0, 1) GROUP BY 1
UNION ALL SELECT run_id, 'error without key', count(*) FROM errors WHERE run_id IS NULL OR id IS NULL GROUP BY 1
UNION ALL SELECT run_id, 'duplicate result id', CAST(sum(copies - 1) AS BIGINT) FROM (
  SELECT run_id, count(*) AS copies FROM results WHERE run_id IS NOT NULL AND id IS NOT NULL GROUP BY run_id, id) r
  WHERE copies > 1 GROUP BY 1
UNION ALL SELECT run_id, 'duplicate error id', CAST(sum(copies - 1) AS BIGINT) FROM (
  SELECT run_id, count(*) AS copies FROM errors WHERE run_id IS NOT NULL AND id IS NOT NULL GROUP BY run_id, id) r
  WHERE copies > 1 GROUP BY 1
UNION ALL SELECT run_id, 'error without its request', count(*) FROM errors e
  WHERE request_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ids i WHERE i.run_id = e.run_id AND i.id = e.request_id)
  GROUP BY 1""",
)
def _(t):
    return archive.integrity_check(t("requests"), t("results"), t("errors"))


@query(
    "archive_once",
    ("runs", "results"),
    """SELECT schema, run_id, uri FROM runs
WHERE NOT drained AND run_id NOT IN (SELECT run_id FROM results)""",
)
def _(t):
    """Runs whose results were harvested count as archived."""
    runs = t("runs")
    archived = runs.join(t("results").select("run_id").distinct(), "run_id", "left_semi")
    finished = runs.where(~F.col("drained")).select("schema", "run_id", "uri")
    return archive.archive_once(finished, archived)


@query(
    "resume_plan",
    ("seeds", "results"),
    """SELECT s.request_no, s.run_id, CASE WHEN k.run_id IS NULL THEN 'seed' ELSE 'resume' END AS action,
  CASE WHEN k.run_id IS NULL THEN s.seed_params END AS seed_params
FROM seeds s LEFT JOIN (SELECT DISTINCT run_id FROM results) k ON s.run_id = k.run_id""",
)
def _(t):
    return archive.resume_plan(t("seeds"), t("results"))


@query(
    "seed_expand",
    ("seeds",),
    """WITH listed AS (
  SELECT request_no, run_id, unnest(from_json(seed_params, '["JSON"]')) AS seed,
    generate_subscripts(from_json(seed_params, '["JSON"]'), 1) - 1 AS position
  FROM seeds WHERE seed_params IS NOT NULL),
entries AS (SELECT *, unnest(json_keys(seed)) AS entry FROM listed)
SELECT request_no, run_id, CAST(position AS INTEGER) AS position, entry,
  CAST(json_extract(seed, '$."' || entry || '"') AS VARCHAR) AS arguments, false AS is_default FROM entries
UNION ALL SELECT request_no, run_id, NULL, NULL, NULL, true FROM seeds WHERE seed_params IS NULL""",
)
def _(t):
    return archive.seed_expand(t("seeds")).drop("seed_params")


@query(
    "archive_write",
    ("runs", "requests"),
    """SELECT u.schema, r.run_id, count(*) AS requests, CAST(sum(r.id) AS BIGINT) AS id_sum
FROM requests r JOIN runs u ON r.run_id = u.run_id GROUP BY 1, 2""",
)
def _(t):
    """Publish the requests of all runs and read the archive back."""
    requests = t("requests").join(t("runs").select("run_id", "schema"), "run_id")
    path = fresh_dir(t.spark, "archive-requests")
    publish_runs(requests, path)
    stored = read_runs(t.spark, path, requests.schema)
    return stored.groupBy("schema", "run_id").agg(
        F.count("*").alias("requests"), F.sum("id").alias("id_sum")
    )
