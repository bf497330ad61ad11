"""Geometry enrichment of cells, its coverage and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridpulse.functions.geometry import centroid, in_box, planar_distance
from gridpulse.operators.sizes import BROADCAST_LIMIT_BYTES, broadcast_if_small
from gridpulse.schemas import ACTIVITY_COLUMNS


def attach_geometry(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left equi-join on the cell; the physical strategy is Catalyst's choice.

    Adaptive execution broadcasts a small lookup and splits a hot cell
    otherwise. The lookup holds one row per cell, so rows are preserved.
    """
    return df.join(lookup.select("grid_id", "geometry"), "grid_id", "left")


def enrich(activity: DataFrame, lookup: DataFrame,
           limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Activity rows with geometry; the lookup is broadcast if measured small."""
    side = broadcast_if_small(lookup.select("grid_id", "geometry"), limit_bytes)
    return activity.join(side, "grid_id", "left").select(*ACTIVITY_COLUMNS)


def key_coverage(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """Per distinct cell of the activity: rows and whether the lookup has it.

    Facts collapse to one row per cell before they meet the lookup.
    """
    cells = activity.groupBy("grid_id").agg(F.count(F.lit(1)).alias("activity_rows"))
    known = (
        lookup.where(F.col("geometry").isNotNull()).select("grid_id").distinct()
        .withColumn("matched", F.lit(True))
    )
    return cells.join(known, "grid_id", "left").withColumn(
        "matched", F.coalesce("matched", F.lit(False))
    )


def coverage(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row: distinct cells, matched cells, coverage percent, unmatched rows."""
    m = F.col("matched")
    return key_coverage(activity, lookup).agg(
        F.count("grid_id").alias("activity_grids"),
        F.count_if(m).alias("matched_grids"),
        F.coalesce(F.sum(F.when(~m, F.col("activity_rows"))), F.lit(0)).alias("unmatched_rows"),
    ).withColumn(
        "coverage_pct",
        F.round(F.try_divide(F.col("matched_grids") * F.lit(100.0), F.col("activity_grids")), 4),
    )


def unmatched_cells(activity: DataFrame, lookup: DataFrame) -> DataFrame:
    """Distinct cells of the activity without a geometry, in order."""
    cells = activity.select("grid_id").distinct()
    known = lookup.where(F.col("geometry").isNotNull()).select("grid_id")
    return cells.join(known, "grid_id", "left_anti").orderBy("grid_id")


def centroids(lookup: DataFrame) -> DataFrame:
    """Longitude and latitude of each cell's centroid; null where undefined."""
    located = lookup.select("grid_id", centroid("geometry").alias("c"))
    return located.select("grid_id", "c.longitude", "c.latitude")


def spot_check(lookup: DataFrame, first: int, second: int, located: int,
               box: tuple[float, float, float, float]) -> DataFrame:
    """One row over three named cells: all located, two apart, one inside the box.

    ``box`` is (min lon, max lon, min lat, max lat).
    """
    named = centroids(lookup.where(F.col("grid_id").isin(first, second, located)))

    def at(cell, column):
        return F.max(F.when(F.col("grid_id") == cell, F.col(column)))

    wide = named.agg(
        F.count("longitude").alias("located_cells"),
        *[at(c, x).alias(f"{x}_{i}") for i, c in enumerate((first, second, located))
          for x in ("longitude", "latitude")],
    )
    distance = planar_distance("longitude_0", "latitude_0", "longitude_1", "latitude_1")
    return wide.select(
        (F.col("located_cells") == len({first, second, located})).alias("all_located"),
        F.round(distance, 8).alias("neighbour_distance"),
        F.coalesce(distance > 0, F.lit(False)).alias("neighbours_differ"),
        F.coalesce(in_box("longitude_2", "latitude_2", box), F.lit(False)).alias("inside_box"),
    )
