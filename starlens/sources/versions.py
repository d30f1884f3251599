"""The current version of the ingested tables under a root (A10).

Tables lie in ``<root>/<table>`` until the first truncation.  A truncation
writes fourteen empty tables into a new folder and then adds one manifest, an
empty file whose name is the folder's, by a rename: readers and sinks see
either all of the old tables or all of the new ones.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

MANIFESTS = "_manifests"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = _path(spark, f"{root}/{MANIFESTS}")
    store = _store(spark, root)
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder)]
    return sorted(int(n[1:]) for n in names if re.fullmatch(r"v\d+", n))


def version_root(spark: SparkSession, root: str) -> str:
    """The folder that holds the tables now."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    return f"{root}/_versions/v{numbers[-1]}" if numbers else root


def next_version(spark: SparkSession, root: str) -> tuple[int, str]:
    """(number, folder) of a version to be written; of an earlier attempt that
    was never switched to, the folder is used again."""
    number = 1 + max([0, *_numbers(spark, root.rstrip("/"))])
    return number, f"{root.rstrip('/')}/_versions/v{number}"


def switch_version(spark: SparkSession, root: str, number: int) -> None:
    """Make a written version the current one, by one rename."""
    root = root.rstrip("/")
    store, folder = _store(spark, root), _path(spark, f"{root}/{MANIFESTS}")
    store.mkdirs(folder)
    draft, final = _path(spark, f"{root}/{MANIFESTS}/.draft-{uuid.uuid4().hex}"), _path(spark, f"{root}/{MANIFESTS}/v{number}")
    store.create(draft, True).close()
    if store.exists(final) or not store.rename(draft, final):
        store.delete(draft, False)
        raise RuntimeError(f"{root}: version {number} was switched to by another writer")
