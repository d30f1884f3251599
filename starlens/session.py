"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are unset, so cluster-provided values always win.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings this library relies on; applied only where the session has none.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sorted buckets of one file each are read as sorted (sources.layout).
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starlens") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STARLENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Streaming checkpoints, sink tables written by queries and lineage cuts go
    there.  Only a local-mode session (tests) that names none gets a fresh
    local folder, recorded in the session; on a cluster the setting is
    required, since a machine-local folder is not visible to other nodes.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="starlens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)  # visible to later callers
        except Exception:  # some deployments reject runtime changes to core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)  # so DataFrame.checkpoint() writes there too
    return path.rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session made, in whatever store it lies."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query that has ended are removed at
    once, and not when the driver happens to collect its garbage.  For jobs of
    many steps that each end in a checkpoint or a write; a frame run twice
    within makes its shuffles again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)
