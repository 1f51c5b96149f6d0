"""Intermediate tables in the folder that every executor can reach.

The folder is the one named by ``spark.checkpoint.dir``. A session whose driver is its only executor
(``local`` or ``local[n]``) and that lacks the setting gets a temporary folder; anywhere else,
``local-cluster`` included, a missing setting is an error, because a machine-local folder would be lost
with its executor.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}
_inside: ContextVar[str | None] = ContextVar("folder of intermediate tables", default=None)


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="cityweave-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, or under the one of ``inside``, that nothing has used before."""
    return f"{_inside.get() or shared_folder(spark) + '/cityweave'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def inside(folder: str) -> Iterator[None]:
    """Intermediate tables made meanwhile lie below ``folder``, so that their owner can delete them together."""
    token = _inside.set(folder)
    try:
        yield
    finally:
        _inside.reset(token)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Steps run meanwhile delete their shuffle files as they end, and not when the driver happens to collect garbage."""
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def durable(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back.

    Cuts the lineage in a way that survives lost executors. The file size also gives the planner a true
    size, so a small result is broadcast in later joins and a large one is not.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
