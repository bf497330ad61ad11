"""Cutting lineage with a written table on storage that all executors share."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from gridpulse.session import local_scratch

# Tables written by this process and not removed yet.
_WRITTEN: list[str] = []
# Tables of the innermost open scope of this thread or task.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process may go without:
    it gets a folder of its own that goes when the process ends. Anywhere else
    a missing setting is an error, since executors do not share local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        spark.sparkContext.setCheckpointDir(local_scratch(spark.sparkContext.master))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str = "table") -> str:
    """A new path below the scratch root, noted for ``drop_scratch``."""
    path = f"{scratch_root(spark)}/gridpulse-{kind}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    if (own := _SCOPE.get()) is not None:
        own.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch tables that are written inside it, and removes them at its end, also after an error.

    Results that read such tables must be written or collected before it ends. An inner scope owns what is its own.
    """
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in own:
            if path in _WRITTEN:
                remove(spark, path)


def scoped(job):
    """``job(spark, ...)`` inside a scope of its own, for jobs that leave written tables and return none."""
    @functools.wraps(job)
    def inside(spark: SparkSession, *args, **kwargs):
        with scope(spark):
            return job(spark, *args, **kwargs)

    return inside


def cut(df: DataFrame, spark: SparkSession | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back, in the session ``spark`` if one is given; ``options`` are those of the writer.

    For frames that several jobs need: they scan columns of a table instead of
    repeating the lineage, and the table outlives lost executors.
    """
    path = scratch_path(df.sparkSession)
    df.write.mode("errorifexists").options(**(options or {})).parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one scratch path through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _WRITTEN:
        _WRITTEN.remove(path)


def drop_scratch(spark: SparkSession) -> int:
    """Remove every table this process wrote; call it when results are consumed."""
    paths = list(_WRITTEN)
    for path in paths:
        remove(spark, path)
    return len(paths)
