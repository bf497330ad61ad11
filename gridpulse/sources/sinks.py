"""Writers by zone contract, measured while writing, verified after."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from gridpulse.operators.layout import balanced
from gridpulse.schemas import LEDGER_COLUMNS, LEDGER_SCHEMA


@dataclass(frozen=True)
class Zone:
    format: str
    mode: str
    partition_by: tuple[str, ...] = ()
    # overwrite replaces only the partitions present in the data
    dynamic: bool = False


# Storage contract, zone -> format, write mode, partitioning.
# Raw and rejected deliveries are partitioned by file and only ever gain files:
# a run claims a name before it writes, and the dynamic overwrite makes its own
# repeated write of that file harmless.
ZONES = {
    "landing": Zone("text", "append"),
    "raw": Zone("csv", "overwrite", ("source_filename",), dynamic=True),
    "rejected": Zone("text", "overwrite", ("source_filename",), dynamic=True),
    "reference": Zone("json", "errorifexists"),
    "processed": Zone("parquet", "overwrite", ("date",), dynamic=True),
    "detail": Zone("parquet", "overwrite", ("row_status", "source_filename"), dynamic=True),
    "by_file": Zone("parquet", "overwrite", ("source_filename",), dynamic=True),
    "processed_append": Zone("parquet", "append", ("date",)),
    "analytics": Zone("parquet", "overwrite"),
    "analytics_append": Zone("parquet", "append"),
    "logs": Zone("parquet", "append"),
    "status": Zone("json", "append"),
    "results": Zone("json", "overwrite"),
    "exports": Zone("csv", "overwrite"),
}


def write_zone(df: DataFrame, path: str, zone: str, metrics: dict | None = None,
               rebalance: bool = False) -> dict:
    """Write under a zone's contract and return counts taken during the write.

    ``metrics`` are aggregate Columns by name; ``rows`` is always among them.
    They ride on the write job, so nothing is counted in a second pass. They
    sit above the rebalancing shuffle, in the stage that writes: there a task
    counts once, however often an earlier stage is redone.
    """
    z = ZONES[zone]
    seen = Observation()
    if rebalance:
        df = balanced(df, *z.partition_by)
    measured = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                          *[c.alias(n) for n, c in (metrics or {}).items()])
    writer = measured.write.mode(z.mode).format(z.format)
    if z.partition_by:
        writer = writer.partitionBy(*z.partition_by)
    if z.dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if z.format == "parquet":
        writer = writer.option("compression", "snappy")
    if z.format == "csv":
        # doubled quotes, so JSON text survives any CSV reader
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return seen.get


def write_csv(df: DataFrame, path: str) -> dict:
    return write_zone(df, path, "exports")


def append_ledger(entries: DataFrame, path: str) -> dict:
    """Add the entries of one run as one file that appears whole.

    Two runs may append at once: each writes apart and moves its file in, so neither clears the other's work.
    """
    spark, staged = entries.sparkSession, f"{path}/_staged-{uuid.uuid4().hex}"
    found = write_zone(entries.select(*LEDGER_COLUMNS).coalesce(1), staged, "logs")
    hadoop_path, fs = _store(spark, path)
    for part in fs.globStatus(hadoop_path(f"{staged}/part-*")):
        source = part.getPath()
        if not fs.rename(source, hadoop_path(path, source.getName())):
            raise OSError(f"{source} could not be moved to {path}")
    fs.delete(hadoop_path(staged), True)
    return found


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The audit ledger; the first call of a lake creates its folder."""
    hadoop_path, fs = _store(spark, path)
    fs.mkdirs(hadoop_path(path))
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _store(spark: SparkSession, path: str):
    """Path class and file system behind ``path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop_path, hadoop_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def claim(spark: SparkSession, folder: str, names: Iterable[str], owner: str) -> list[str]:
    """The names that belong to somebody else; all others are ``owner``'s from now on, whoever asks later.

    A claim is a file per name that is created only where there is none, in one step of the store (object stores without
    such a step give no guarantee). It holds its owner, so a run that broke off finds its own claims again. Names come
    one at a time; the driver makes one small request for each.
    """
    hadoop_path, fs = _store(spark, folder)
    fs.mkdirs(hadoop_path(folder))
    lost = []
    for name in names:
        path = hadoop_path(folder, quote(name, safe=""))
        if _created(spark, fs, path):
            out = fs.create(path, True)
            out.write(owner.encode())
            out.close()
        elif _owner(spark, fs, path) != owner:
            lost.append(name)
    return lost


def _created(spark: SparkSession, fs, path) -> bool:
    if fs.getUri().getScheme() == "file":  # Hadoop's own local store looks first and creates then
        return spark._jvm.java.io.File(path.toUri().getPath()).createNewFile()
    try:
        fs.create(path, False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False


def _owner(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def release(spark: SparkSession, folder: str, keep: Iterable[str]) -> int:
    """Remove the claims on names that are not in ``keep``, left by runs that broke off; no run may be active."""
    hadoop_path, fs = _store(spark, folder)
    kept, gone = {quote(n, safe="") for n in keep}, 0
    for found in fs.globStatus(hadoop_path(f"{folder}/*")) or []:
        if found.getPath().getName() not in kept:
            gone += fs.delete(found.getPath(), False)
    return gone


def verify(spark: SparkSession, path: str, expected_rows: int, columns=None,
           not_null: tuple[str, ...] = ()) -> DataFrame:
    """Read a table back and compare; raises on a difference.

    One aggregate; with no column to inspect the row count comes from footers.
    """
    df = spark.read.parquet(path)
    if columns is not None and set(df.columns) != set(columns):
        raise ValueError(f"{path}: columns {df.columns} differ from {list(columns)}")
    got = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first()
    if got["rows"] != expected_rows:
        raise ValueError(f"{path}: {got['rows']} rows, expected {expected_rows}")
    bad = [c for c in not_null if got[c]]
    if bad:
        raise ValueError(f"{path}: nulls in {bad}")
    return df


def replace_partitions(df: DataFrame, path: str) -> dict:
    """Rebuild only the dates present in ``df``; other dates stay as they are."""
    return write_zone(df, path, "processed", rebalance=True)


def append_partitions(df: DataFrame, path: str) -> dict:
    """Add rows of new dates."""
    return write_zone(df, path, "processed_append", rebalance=True)
