"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings that are right at any scale. Partition counts and memory belong
# to the cluster; adaptive execution sizes the shuffles from what it measures.
SCALE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def heap_megabytes() -> int:
    """Half of this machine's memory, 16 GB at most; the rest is for Python and the file cache."""
    memory = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return min(16384, memory // 2**21)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "crawlsight"):
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", f"{heap_megabytes()}m")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SCALE_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> None:
    """Set the session-level settings on a session that somebody else built."""
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder,
    which goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        # local-cluster[..] is several processes, and so a cluster.
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="crawlsight-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored; nothing happens where none is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder, once."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
