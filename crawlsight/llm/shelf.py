"""Tables between the steps of an operator: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_dir


class Shelf:
    """Tables of one call, by name.

    Reading a table back packs small files into few tasks, and lineage ends at its files, which outlive
    executors. A name that is put again replaces its table, once the new one is written; what is dropped is deleted.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder = spark, fresh_dir(spark, name)
        self.paths: dict[str, str] = {}
        self.count = 0

    def put(self, name: str, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{name}-{self.count}"
        frame.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.paths.pop(name, None)
            if path is not None:
                place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def tasks_for(spark: SparkSession, rows: int, each: int = 100_000) -> int:
    """Tasks for so many small rows: all cores, and more from ``each`` rows per core on."""
    return max(spark.sparkContext.defaultParallelism, rows // each)
