"""Physical layout of a table before it is written or aggregated again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def by_key(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash layout on a key. Adaptive execution sizes it when no number is given."""
    return df.repartition(partitions, key) if partitions else df.repartition(key)


def bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path`` in buckets of a key, sorted by it, and read it as that table.

    Joins, groupings and windows on the key then need no shuffle, which a plain hash layout loses once it is written.
    A key is one task here: right for a grain that bounds the rows of a key, as the hourly grid does for a cell. One
    file per bucket: rows are laid out by the same hash first.
    """
    by_key(df, key, buckets).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even output files: small partitions merge and a skewed one is split.

    Unlike a plain repartition on the columns, one date or cell that holds most
    rows does not end up in one task.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def fewer(df: DataFrame, partitions: int, factor: int = 2) -> DataFrame:
    """Divide the number of partitions, which the caller knows, without a shuffle."""
    return df.coalesce(max(1, partitions // factor))


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per physical partition, the view that shows skew."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("rows")
    ).orderBy("partition_id")


def key_spread(df: DataFrame, key: str) -> DataFrame:
    """Per key: its rows and how many partitions they lie in; 1 after ``by_key``."""
    pieces = df.groupBy(key, F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    return pieces.groupBy(key).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("partitions"))


def partition_summary(df: DataFrame) -> DataFrame:
    """One row: rows in all partitions together, non-empty partitions, largest share."""
    return partition_rows(df).agg(
        F.sum("rows").alias("row_count"),
        F.count(F.lit(1)).alias("partition_count"),
        F.max("rows").alias("largest_partition"),
    )
