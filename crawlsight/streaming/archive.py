"""The archive kept up to date while downloads arrive."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import archive
from ..sources.tables import optional_table
from .drain import for_each_batch

# Hex digits of the hash that name a folder of objects: 16 folders, so that a batch writes few files.
SHARD_DIGITS = 1
OBJECT_ROWS = "content_key string, size bigint, content string, first_seq bigint, shard string, batch_id bigint"
POINTER_ROWS = "prefix string, dedup_sha string, file_url string, seq bigint, batch_id bigint"


def stored_objects(spark: SparkSession, root: str, shards: Collection[str] | None = None) -> DataFrame:
    """Stored objects; with ``shards``, those of these shards: no other folder is listed or read."""
    table = f"{root}/objects"
    if shards is None:
        return optional_table(spark, table, OBJECT_ROWS)
    if not shards:
        return spark.createDataFrame([], OBJECT_ROWS)
    return optional_table(spark, f"{table}/shard={{{','.join(sorted(shards))}}}", OBJECT_ROWS, table)


def stored_pointers(spark: SparkSession, root: str) -> DataFrame:
    """Current pointers: of each key the one written last."""
    return (
        optional_table(spark, f"{root}/pointers", POINTER_ROWS)
        .groupBy("prefix", "dedup_sha")
        .agg(F.max_by("file_url", F.struct("batch_id", "seq")).alias("file_url"))
    )


def archive_batch(root: str, base: str = archive.FILE_BASE) -> Callable[[DataFrame, int], None]:
    """Handler that adds one micro-batch to the archive.

    Objects lie by the beginning of their hash and batch, so a batch meets the keys of its own shards alone.
    Each batch owns one folder per shard and table and compares itself with earlier batches
    only. A replayed batch therefore finds the same state and writes the same
    folders again: nothing is doubled and nothing rewritten.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read and hashed once for all that follows.
        keyed = archive.with_keys(batch).persist()
        try:
            shard = F.substring(archive.shard_of(F.col("content_key")), 1, SHARD_DIGITS).alias("shard")
            # At most 16 ** SHARD_DIGITS values.
            shards = [row.shard for row in keyed.select(shard).distinct().collect()]
            earlier = stored_objects(spark, root, shards).where(F.col("batch_id") < batch_id)
            new = archive.keyed_to_write(keyed, earlier)
            (
                new.select("*", shard, F.lit(batch_id).cast("bigint").alias("batch_id"))
                .hint("rebalance", "shard")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("shard", "batch_id")
                .parquet(f"{root}/objects")
            )
            pointers = archive.keyed_pointers(keyed, base)
            pointers.write.mode("overwrite").parquet(f"{root}/pointers/batch_id={batch_id}")
        finally:
            keyed.unpersist()

    return handle


def archive_stream(downloads: DataFrame, root: str, checkpoint: str) -> None:
    for_each_batch(downloads, archive_batch(root), checkpoint)
