"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession


def get_spark(app: str = "landledger", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the warehouse relies on.

    On a cluster leave ``shuffle_partitions`` unset: adaptive execution starts
    from the configured number and coalesces to the advisory partition size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot join key even when the aggregate above it then needs
        # one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_dir() -> str:
    folder = tempfile.mkdtemp(prefix="run-landledger-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a session that runs in one process (master ``local``), as in trials, may
    leave it unset and gets a folder of its own until it ends; on a cluster that is
    an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        return _own_dir()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "landledger", uuid.uuid4().hex, name)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store its path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    if not exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [found.getPath().getName() for found in store.listStatus(place)]


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one of the same store."""
    remove(spark, target)
    place = spark._jvm.org.apache.hadoop.fs.Path(source)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} cannot be moved to {target}")


# Settings of a job of many stages: a stage's shuffle files go when it has ended rather
# than when the driver happens to collect garbage, and tables are stored compactly.
SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """``SPARING`` for what runs inside; the session is left as it was."""
    before = {key: spark.conf.get(key, None) for key in SPARING}
    for key, value in SPARING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
