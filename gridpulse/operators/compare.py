"""Cross-table comparison. Both sides meet in one union and one shuffle on the
key, with counts and sums combined map-side; no join, no pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridpulse.functions.columns import rounded
from gridpulse.schemas import DECIMALS, HOURLY_GRAIN, MEASURES


def key_sets(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows and distinct keys per side, keys only on one side, equality."""
    def side(df, flag):
        return df.select(*keys, F.lit(flag).alias("_l"), F.lit(1 - flag).alias("_r"))

    per_key = side(left, 1).unionByName(side(right, 0)).groupBy(*keys).agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r")
    )
    l, r = F.col("_l"), F.col("_r")
    return per_key.agg(
        F.coalesce(F.sum(l), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(r), F.lit(0)).alias("right_rows"),
        F.count_if(l > 0).alias("left_keys"),
        F.count_if(r > 0).alias("right_keys"),
        F.count_if((l > 0) & (r == 0)).alias("only_left"),
        F.count_if((l == 0) & (r > 0)).alias("only_right"),
    ).withColumn("keys_equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def _reconciled(clean: DataFrame, hourly: DataFrame, decimals: int) -> DataFrame:
    detail = clean.select(*HOURLY_GRAIN, F.lit(1).alias("_d"), F.lit(0).alias("_s"),
                          *[F.col(m) for m in MEASURES], *[F.lit(0.0).alias(f"_s_{m}") for m in MEASURES])
    stored = hourly.select(*HOURLY_GRAIN, F.lit(0).alias("_d"), F.lit(1).alias("_s"),
                           *[F.lit(0.0).alias(m) for m in MEASURES],
                           *[F.col(m).alias(f"_s_{m}") for m in MEASURES])
    per_key = detail.unionByName(stored).groupBy(*HOURLY_GRAIN).agg(
        F.sum("_d").alias("_d"), F.sum("_s").alias("_s"),
        *[rounded(F.sum(m), decimals).alias(m) for m in MEASURES],
        *[F.sum(f"_s_{m}").alias(f"_s_{m}") for m in MEASURES],
    )
    tolerance = 0.5 * 10.0 ** -decimals
    off = [F.abs(F.col(m) - F.col(f"_s_{m}")) > tolerance for m in MEASURES]
    differs = off[0]
    for o in off[1:]:
        differs = differs | o
    return per_key.withColumn("_differs", differs)


def reconcile(clean: DataFrame, hourly: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """One row: every key's re-summed detail against the stored hourly row."""
    both = (F.col("_d") > 0) & (F.col("_s") > 0)
    return _reconciled(clean, hourly, decimals).agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_s") == 0).alias("missing_in_hourly"),
        F.count_if(F.col("_d") == 0).alias("missing_in_detail"),
        F.count_if(F.col("_s") > 1).alias("stored_more_than_once"),
        F.count_if(both & F.col("_differs")).alias("mismatched_keys"),
    )


def reconcile_key(clean: DataFrame, hourly: DataFrame, timestamp, grid_id: int,
                  decimals: int = DECIMALS) -> DataFrame:
    """Hand check of one key: re-summed and stored value per measure.

    The key filter reaches both scans.
    """
    point = (F.col("timestamp") == F.lit(timestamp)) & (F.col("grid_id") == F.lit(grid_id))
    one = _reconciled(clean.where(point), hourly.where(point), decimals)
    return one.select(*HOURLY_GRAIN, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("recomputed"), F.col(f"_s_{m}").alias("stored"))
        for m in MEASURES
    ])))


def first_key(hourly: DataFrame) -> DataFrame:
    """The smallest (timestamp, grid_id)."""
    return hourly.orderBy(*HOURLY_GRAIN).select(*HOURLY_GRAIN).limit(1)


def row_conservation(input_rows, rejected_rows, clean_rows):
    """input = rejected + clean, as a Column over three counts."""
    return F.col(input_rows) == F.col(rejected_rows) + F.col(clean_rows)
