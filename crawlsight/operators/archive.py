"""Content-addressed archive: keys, dedup pointers, idempotent upserts, verification.

Only keys, sizes and sequence numbers are shuffled. Bytes that lie in files are fetched by place
and stay in the task that reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from ..session import ensure_checkpoint_dir
from ..sources.schemas import REQUEST_STATUSES

FILE_BASE = "s3://files/"

VERIFY_SHARDS = 4096  # Digests that a verification compares first.

# Rows of a file that one mark tells about, a bit each in words of 64.
MARKED_ROWS = 4096
# Marks that are broadcast at a time: about 50 MB, for 268 million rows.
MOST_MARKS = 65536


def with_keys(downloads: DataFrame) -> DataFrame:
    """Add hash, extension, object key and size; one pass over the bytes, no shuffle."""
    return (
        downloads.withColumn("sha", keys.content_sha(F.col("content")))
        .withColumn("ext", keys.file_extension(F.col("url"), F.col("expected_type")))
        .withColumn("content_key", keys.content_key(F.col("prefix"), F.col("sha"), F.col("ext")))
        .withColumn("size", F.octet_length(F.col("content")).cast("bigint"))
    )


def _pointer_sha(downloads: DataFrame) -> DataFrame:
    """Hash of the dedup key. Rows without a key get a value that matches no hash and
    differs by URL, so they neither match nor pile up in one task."""
    key = F.col("deduplication_key")
    return downloads.withColumn(
        "dedup_sha",
        F.when(keys.has_key(key), keys.content_sha(key)).otherwise(F.concat(F.lit("none "), F.col("url"))),
    )


def download_plan(candidates: DataFrame, pointers: DataFrame) -> DataFrame:
    """Per candidate: the stored file where a pointer exists, else download."""
    asked = _pointer_sha(candidates.select("prefix", "url", "deduplication_key", "seq"))
    known = pointers.select("prefix", "dedup_sha", "file_url")
    return asked.join(known, ["prefix", "dedup_sha"], "left").select(
        "prefix", "url", "seq", F.col("file_url").isNull().alias("download"), "file_url"
    )


def downloads_needed(candidates: DataFrame, pointers: DataFrame) -> DataFrame:
    asked = _pointer_sha(candidates.select("prefix", "url", "deduplication_key", "seq"))
    return asked.join(pointers, ["prefix", "dedup_sha"], "left_anti").select("prefix", "url", "seq")


def downloads_skipped(candidates: DataFrame, pointers: DataFrame) -> DataFrame:
    asked = _pointer_sha(candidates.select("prefix", "url", "deduplication_key", "seq"))
    return asked.join(pointers, ["prefix", "dedup_sha"], "left_semi").select("prefix", "url", "seq")


def objects_of(downloads: DataFrame) -> DataFrame:
    """One row per object: equal bytes with equal extension and prefix are one."""
    return keyed_objects(with_keys(downloads))


def keyed_objects(keyed: DataFrame) -> DataFrame:
    """As ``objects_of``, of downloads that have their keys."""
    return keyed.groupBy("content_key").agg(F.max("size").alias("size"), F.min("seq").alias("first_seq"))


def content_upsert(downloads: DataFrame, objects: DataFrame) -> DataFrame:
    """Objects that ``downloads`` adds to the stored ``objects``."""
    return objects_of(downloads).join(objects.select("content_key"), "content_key", "left_anti")


def content_to_write(downloads: DataFrame, objects: DataFrame) -> DataFrame:
    """The bytes behind :func:`content_upsert`: for each new object its first copy.

    For downloads of any origin; :func:`content_by_place` moves less where they lie in files.
    """
    return keyed_to_write(with_keys(downloads), objects)


def keyed_to_write(keyed: DataFrame, objects: DataFrame) -> DataFrame:
    """As ``content_to_write``, of downloads that have their keys.

    Winners are found on keys alone. The join that fetches their bytes moves the bytes of all downloads, unless
    the winners are few enough to be broadcast.
    """
    first = keyed_objects(keyed).join(objects.select("content_key"), "content_key", "left_anti")
    first = first.select("content_key", F.col("first_seq").alias("seq"))
    return keyed.join(first, ["content_key", "seq"], "left_semi").select(
        "content_key", "size", "content", F.col("seq").alias("first_seq")
    )


def content_by_place(downloads: DataFrame, objects: DataFrame, most_marks: int = MOST_MARKS) -> DataFrame:
    """As ``content_to_write``, for downloads with their ``file_path`` and ``row_index`` (see ``sources.tables.placed``).

    The first scan hashes the bytes and finds the winners' places; only keys and places are shuffled. The places become
    bits, one mark for ``MARKED_ROWS`` rows of a file, and the second scan keeps the rows whose bit is set: no byte of
    a download is shuffled, neither of winners nor of losers. Marks are broadcast, ``most_marks`` at a time. Where
    there are more, each portion has a scan of its own, which opens that portion's files alone.
    Of two rows with equal key and ``seq``, the first by file and row is written. The first scan runs at once.
    """
    first = with_keys(downloads).groupBy("content_key").agg(F.min(F.struct("seq", "file_path", "row_index")).alias("first"))
    new = first.join(objects.select("content_key"), "content_key", "left_anti").select("first.file_path", "first.row_index")
    ensure_checkpoint_dir(downloads.sparkSession)
    marks = _portions(place_marks(new), most_marks).checkpoint()
    # A row per portion.
    portions = marks.groupBy("portion").agg(F.min("file_path").alias("low"), F.max("file_path").alias("high")).collect()
    part = F.expr(f"row_index div {MARKED_ROWS}")
    word = F.get("words", F.expr(f"int(row_index % {MARKED_ROWS} div 64)"))
    kept = downloads.where(F.lit(False))
    for portion in sorted(portions):
        chosen = F.broadcast(marks.where(F.col("portion") == portion.portion).drop("portion"))
        rows = downloads.where(F.col("file_path").between(portion.low, portion.high)).withColumn("part", part)
        marked = rows.join(chosen, ["file_path", "part"]).where(F.getbit(word, F.expr("int(row_index % 64)")) == 1)
        kept = kept.unionByName(marked.select(*downloads.columns))
    return with_keys(kept).select("content_key", "size", "content", F.col("seq").alias("first_seq"))


def place_marks(places: DataFrame) -> DataFrame:
    """file_path, part, words: a bit for each of the ``places`` (file_path, row_index)."""
    bit = F.expr("shiftleft(1L, int(row_index % 64))")
    words = places.groupBy(
        "file_path",
        F.expr(f"row_index div {MARKED_ROWS}").alias("part"),
        F.expr(f"int(row_index % {MARKED_ROWS} div 64)").alias("word"),
    ).agg(F.bit_or(bit).alias("bits"))
    # At most 64 words meet in a group.
    marked = words.groupBy("file_path", "part").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("by_word"))
    every = F.sequence(F.lit(0), F.lit(MARKED_ROWS // 64 - 1))
    filled = F.transform(every, lambda i: F.coalesce(F.col("by_word")[i], F.lit(0).cast("bigint")))
    return marked.select("file_path", "part", filled.alias("words"))


def _portions(marks: DataFrame, most: int) -> DataFrame:
    """Add the portion of each mark, ``most`` marks in the order of files to a portion."""
    # The sums over all files have a row per file.
    earlier = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    files = marks.groupBy("file_path").agg(F.count("*").alias("n"))
    files = files.select("file_path", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("file_path").orderBy("part")) - 1
    ranked = marks.withColumn("rank", rank).join(files, "file_path")
    return ranked.select("file_path", "part", "words", F.expr(f"(before + rank) div {most}").alias("portion"))


def pointers_of(downloads: DataFrame, base: str = FILE_BASE) -> DataFrame:
    """The pointer each dedup key ends up with, and the sequence number that set it."""
    return keyed_pointers(with_keys(downloads.where(keys.has_key(F.col("deduplication_key")))), base)


def keyed_pointers(keyed: DataFrame, base: str = FILE_BASE) -> DataFrame:
    """As ``pointers_of``, of downloads that have their keys."""
    keyed = keyed.where(keys.has_key(F.col("deduplication_key"))).select(
        "prefix",
        keys.content_sha(F.col("deduplication_key")).alias("dedup_sha"),
        F.concat(F.lit(base), F.col("content_key")).alias("file_url"),
        "seq",
    )
    return keyed.groupBy("prefix", "dedup_sha").agg(
        F.max_by("file_url", "seq").alias("file_url"), F.max("seq").alias("seq")
    )


def pointer_upsert(downloads: DataFrame, pointers: DataFrame, base: str = FILE_BASE) -> DataFrame:
    """Pointers after ``downloads``: the last write of a key wins over all earlier ones.

    Old and new rows are folded in one aggregation instead of an anti join and a union.
    """
    new = pointers_of(downloads, base).withColumn("turn", F.lit(1))
    old = pointers.select(
        "prefix", "dedup_sha", "file_url", F.lit(None).cast("bigint").alias("seq"), F.lit(0).alias("turn")
    )
    return (
        old.unionByName(new)
        .groupBy("prefix", "dedup_sha")
        .agg(F.max_by("file_url", "turn").alias("file_url"))
    )


def archive_savings(downloads: DataFrame) -> DataFrame:
    """Per prefix: downloads and bytes against the objects and bytes that are stored."""
    per_object = (
        with_keys(downloads)
        .groupBy("prefix", "content_key")
        .agg(F.count("*").alias("copies"), F.max("size").alias("size"))
    )
    return per_object.groupBy("prefix").agg(
        F.sum("copies").alias("downloads"),
        F.count("*").alias("objects"),
        F.sum(F.col("size") * F.col("copies")).alias("bytes"),
        F.sum("size").alias("stored_bytes"),
    )


def shard_of(content_key: Column) -> Column:
    """The first shard of an object key."""
    return F.regexp_extract(content_key, "([0-9a-f]{2})/[0-9a-f]{2}/[^/]*$", 1)


def shard_histogram(downloads: DataFrame) -> DataFrame:
    """Objects per prefix and first shard of the key layout."""
    objects = with_keys(downloads).select("prefix", "sha", "content_key").groupBy(
        "prefix", F.substring("sha", 1, 2).alias("shard"), "content_key"
    )
    return objects.agg(F.count("*").alias("copies")).groupBy("prefix", "shard").agg(
        F.count("*").alias("objects")
    )


def archive_verify(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Compare what should be stored with what is, by path and size."""
    wanted = manifest.select("path", F.col("size").alias("expected_size"))
    stored = listing.select("path", F.col("size").alias("stored_size"))
    status = (
        F.when(F.col("stored_size").isNull(), "missing")
        .when(F.col("expected_size").isNull(), "unexpected")
        .when(F.col("stored_size") != F.col("expected_size"), "size_mismatch")
        .otherwise("ok")
    )
    return wanted.join(stored, "path", "full_outer").withColumn("status", status)


def shard_digests(rows: DataFrame, shards: int = VERIFY_SHARDS) -> DataFrame:
    """One row per shard of (path, size): how many, how large, and two digests that no order changes."""
    shard = F.pmod(F.xxhash64("path"), F.lit(shards)).alias("shard")
    return rows.groupBy(shard).agg(
        F.count("*").alias("files"),
        F.sum(F.col("size").cast("decimal(38,0)")).alias("bytes"),
        F.bit_xor(F.xxhash64("path", "size")).alias("mixed"),
        F.sum(F.xxhash64("size", "path").cast("decimal(38,0)")).alias("added"),
    )


def archive_differences(manifest: DataFrame, listing: DataFrame, shards: int = VERIFY_SHARDS) -> DataFrame:
    """The rows of :func:`archive_verify` that are not ok, for archives that are mostly whole.

    Both sides send ``shards`` digests, counted where the rows lie. Only rows of shards whose digests differ are compared
    with each other; a whole archive moves no row. ``shards`` bounds what is broadcast.
    """
    marks = ["files", "bytes", "mixed", "added"]
    sides = [shard_digests(rows.select("path", "size"), shards) for rows in (manifest, listing)]
    same = F.lit(True)
    for mark in marks:
        same = same & F.col(f"m.{mark}").eqNullSafe(F.col(f"l.{mark}"))
    both = sides[0].alias("m").join(sides[1].alias("l"), F.col("m.shard") == F.col("l.shard"), "full_outer")
    differing = F.broadcast(both.where(~same).select(F.coalesce("m.shard", "l.shard").alias("shard")))

    def concerned(rows: DataFrame) -> DataFrame:
        told = rows.select("path", "size").withColumn("shard", F.pmod(F.xxhash64("path"), F.lit(shards)))
        return told.join(differing, "shard", "left_semi").drop("shard")

    return archive_verify(concerned(manifest), concerned(listing)).where("status <> 'ok'")


def dangling_pointers(pointers: DataFrame, objects: DataFrame, base: str = FILE_BASE) -> DataFrame:
    """Pointers whose object is not stored."""
    there = objects.select(F.concat(F.lit(base), F.col("content_key")).alias("file_url"))
    return pointers.join(there, "file_url", "left_anti").select("prefix", "dedup_sha", "file_url")


def integrity_check(requests: DataFrame, results: DataFrame, errors: DataFrame) -> DataFrame:
    """Broken table rules as (run_id, issue, n); empty when the run tables are sound.

    Rules on single rows are counted in one pass per table. Ids are counted once
    more: that shuffle answers both the uniqueness rule and the question whether
    an error's request exists.
    """

    def row_rules(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
        counted = rows.groupBy("run_id").agg(
            *[F.count_if(broken).alias(f"n{i}") for i, broken in enumerate(rules.values())]
        )
        issues = [
            F.struct(F.lit(name).alias("issue"), F.col(f"n{i}").alias("n"))
            for i, name in enumerate(rules)
        ]
        return counted.select("run_id", F.inline(F.array(*issues))).where(F.col("n") > 0)

    def per_run(name: str, rows: DataFrame, n: Column) -> DataFrame:
        return rows.groupBy("run_id").agg(n.alias("n")).select("run_id", F.lit(name).alias("issue"), "n")

    known = F.coalesce(F.col("status").isin(*REQUEST_STATUSES), F.lit(False))
    no_key = F.col("run_id").isNull() | F.col("id").isNull()
    odd_flag = F.coalesce(~F.col("is_valid").isin(0, 1), F.lit(False))
    ids = requests.groupBy("run_id", "id").agg(F.count("*").alias("copies"))
    doubled = {
        f"duplicate {name} id": rows.where(~no_key).groupBy("run_id", "id").agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
        for name, rows in (("result", results), ("error", errors))
    }
    asked = (
        errors.where(F.col("request_id").isNotNull())
        .groupBy("run_id", F.col("request_id").alias("id"))
        .agg(F.count("*").alias("k"))
    )
    orphans = asked.join(ids, ["run_id", "id"], "left_anti")
    found = (
        row_rules(requests, {"request without key": no_key, "unknown request status": ~known})
        .unionByName(row_rules(results, {"result without key": no_key, "result flag not 0 or 1": odd_flag}))
        .unionByName(row_rules(errors, {"error without key": no_key}))
        .unionByName(per_run("duplicate request id", ids.where(F.col("copies") > 1), F.sum(F.col("copies") - 1)))
        .unionByName(per_run("error without its request", orphans, F.sum("k")))
    )
    for name, copies in doubled.items():
        found = found.unionByName(per_run(name, copies, F.sum(F.col("copies") - 1)))
    return found


def require_none(bad: DataFrame, what: str, path: str, shown: int = 20) -> None:
    """Raise if there are rows. All of them are written to ``path``; the message says how many, and names a few."""
    if bad.isEmpty():
        return
    bad.write.mode("overwrite").parquet(path)
    kept = bad.sparkSession.read.schema(bad.schema).parquet(path)
    lines = [" ".join(str(value) for value in row) for row in kept.orderBy(*kept.columns).limit(shown).collect()]
    raise RuntimeError("\n".join([f"{what}: {kept.count()} rows, all of them in {path}", *lines]))


def archive_once(finished: DataFrame, archived: DataFrame) -> DataFrame:
    """Finished runs that are not in the archive's manifest yet."""
    return finished.join(archived.select("schema", "run_id"), ["schema", "run_id"], "left_anti")


def resume_plan(asked: DataFrame, existing: DataFrame) -> DataFrame:
    """Runs that exist go on and ignore new seeds; the others are seeded."""
    known = existing.select("run_id").distinct().withColumn("known", F.lit(True))
    resumes = F.coalesce(F.col("known"), F.lit(False))
    return asked.join(known, "run_id", "left").select(
        *[name for name in asked.columns if name != "seed_params"],
        F.when(resumes, "resume").otherwise("seed").alias("action"),
        F.when(~resumes, F.col("seed_params")).alias("seed_params"),
    )


def seed_expand(asked: DataFrame) -> DataFrame:
    """One row per (entry, arguments) of the seed list; no list means the default entries."""
    seeds = F.from_json("seed_params", "array<map<string,string>>")
    listed = (
        asked.where(F.col("seed_params").isNotNull())
        .select("*", F.posexplode(seeds).alias("position", "seed"))
        .select(*asked.columns, "position", F.explode("seed").alias("entry", "arguments"))
    )
    defaults = asked.where(F.col("seed_params").isNull()).select(
        *asked.columns,
        F.lit(None).cast("int").alias("position"),
        F.lit(None).cast("string").alias("entry"),
        F.lit(None).cast("string").alias("arguments"),
    )
    return listed.unionByName(defaults).withColumn("is_default", F.col("entry").isNull())
