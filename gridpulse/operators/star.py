"""Star schema: two dimensions, one fact table, and their key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from gridpulse.functions.columns import calendar
from gridpulse.operators.aggregate import grid_geometry
from gridpulse.operators.ordering import ordinal
from gridpulse.operators.sizes import BROADCAST_LIMIT_BYTES, broadcast_if_small
from gridpulse.schemas import FACT_MEASURES
from gridpulse.sources.scratch import cut


def dim_time(hourly: DataFrame) -> DataFrame:
    """Distinct timestamps with a 1-based key in time order and calendar fields.

    The timestamps are stored first: numbering reads them twice.
    """
    stamps = cut(hourly.where(F.col("timestamp").isNotNull()).select("timestamp").distinct())
    keyed = ordinal(stamps, [{"_day": F.to_date("timestamp")}], ["timestamp"], "time_id")
    return keyed.withColumns(calendar()).select(
        F.col("time_id").cast("int").alias("time_id"), "timestamp", "date", "hour", "day_of_week"
    )


def dim_grid(hourly: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """One row per cell with its geometry.

    The cells come from the facts as bare keys; the geometry comes from the
    lookup, or from the rows themselves when they carry it.
    """
    cells = hourly.where(F.col("grid_id").isNotNull()).select("grid_id").distinct()
    source = grid_geometry(hourly) if lookup is None else lookup.select("grid_id", "geometry")
    return cells.join(source, "grid_id", "left").select(
        F.col("grid_id").cast("int").alias("grid_id"), "geometry"
    )


def fact_activity(hourly: DataFrame, times: DataFrame,
                  limit_bytes: int | None = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Measures under (time_id, grid_id); rows without a known timestamp drop.

    The key column of the time dimension is broadcast after its size has been
    measured. ``limit_bytes=None`` skips the measuring and leaves the join to
    adaptive execution.
    """
    keys = times.select("timestamp", "time_id")
    if limit_bytes is not None:
        keys = broadcast_if_small(keys, limit_bytes)
    return hourly.join(keys, "timestamp").select(
        "time_id", F.col("grid_id").cast("int").alias("grid_id"), *FACT_MEASURES
    )


def dated_fact(hourly: DataFrame) -> DataFrame:
    """Facts under (date, time_no, grid_id): the number of the timestamp inside its date, which no other date moves."""
    stamps = hourly.where(F.col("timestamp").isNotNull()).select("date", "timestamp").distinct()
    numbers = stamps.select("timestamp", F.row_number().over(W.partitionBy("date").orderBy("timestamp")).alias("time_no"))
    return hourly.join(numbers, "timestamp").select("date", "time_no", F.col("grid_id").cast("int").alias("grid_id"), *FACT_MEASURES)


def numbered_fact(dated: DataFrame, offsets: DataFrame) -> DataFrame:
    """``fact_activity`` out of dated facts: ``offsets`` (date, before) has a row per date, so a late date rewrites no facts."""
    joined = dated.join(broadcast_if_small(offsets), "date")
    return joined.select((F.col("before") + F.col("time_no")).cast("int").alias("time_id"), "grid_id", *FACT_MEASURES)


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row: fact rows whose key the dimension lacks.

    Facts are counted per key first, so the anti join moves keys, not facts.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"))


def orphan_summary(fact: DataFrame, times: DataFrame, grids: DataFrame) -> DataFrame:
    """Orphan fact rows per dimension."""
    return (
        orphan_rows(fact, times, "time_id").withColumn("dimension", F.lit("dim_time"))
        .unionByName(orphan_rows(fact, grids, "grid_id").withColumn("dimension", F.lit("dim_grid")))
        .select("dimension", "orphan_rows")
    )


def constraint_summary(fact: DataFrame, times: DataFrame, grids: DataFrame) -> DataFrame:
    """Declared keys as rows (constraint, violations): primary keys, unique
    timestamp, not-null measures and both foreign keys."""
    def repeats(df, keys, name):
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return g.agg((F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("violations")).select(
            F.lit(name).alias("constraint_name"), "violations")

    nulls = sum((F.col(m).isNull().cast("int") for m in FACT_MEASURES[1:]),
                F.col(FACT_MEASURES[0]).isNull().cast("int"))
    parts = [
        repeats(times, ["time_id"], "dim_time primary key"),
        repeats(times, ["timestamp"], "dim_time unique timestamp"),
        repeats(grids, ["grid_id"], "dim_grid primary key"),
        repeats(fact, ["time_id", "grid_id"], "fact primary key"),
        fact.agg(F.coalesce(F.sum(nulls), F.lit(0)).alias("violations")).select(
            F.lit("fact measures not null").alias("constraint_name"), "violations"),
        orphan_rows(fact, times, "time_id").select(
            F.lit("fact time foreign key").alias("constraint_name"),
            F.col("orphan_rows").alias("violations")),
        orphan_rows(fact, grids, "grid_id").select(
            F.lit("fact grid foreign key").alias("constraint_name"),
            F.col("orphan_rows").alias("violations")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
