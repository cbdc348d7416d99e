"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in a local session that names none, a temporary folder from then on."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="weir-shared-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return root.rstrip("/")


#: Paths made within each scope that is open, the innermost last.
_scopes: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one folder an application; it goes with the scope that is open, if any."""
    path = f"{shared_folder(spark)}/weir-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes what was written to scratch() within: for work whose result is written elsewhere before the scope ends."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def clean_up(spark: SparkSession) -> None:
    """Removes all of the application's scratch paths, once none of its results is read any more."""
    remove(spark, f"{shared_folder(spark)}/weir-{spark.sparkContext.applicationId}")
