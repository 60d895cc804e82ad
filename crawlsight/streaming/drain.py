"""Running a stream to the end of its present input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..session import fresh_dir
from ..sources.tables import optional_table


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what has arrived, then stop. Progress is kept in ``checkpoint``."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append finished rows to a Parquet sink, whose log makes replays harmless."""
    drain(
        stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint
    )


def for_each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    drain(stream.writeStream.foreachBatch(handle), checkpoint)


def drained_table(stream: DataFrame, name: str) -> DataFrame:
    """Drain ``stream`` into a new table below the shared folder and read that."""
    spark = stream.sparkSession
    path = fresh_dir(spark, name)
    to_parquet(stream, path, fresh_dir(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


def drained_latest(stream: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Drain an aggregation in update mode; the newest state of every group, open windows included.

    Each batch writes the groups that it changed to a folder of its own, so a replayed batch replaces
    what it wrote before.
    """
    spark = stream.sparkSession
    path = fresh_dir(spark, name)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    drain(stream.writeStream.outputMode("update").foreachBatch(keep), fresh_dir(spark, f"{name}-checkpoint"))
    states = optional_table(spark, path, f"{stream.schema.toDDL()}, batch_id long")
    newest = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return states.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age", "batch_id")
