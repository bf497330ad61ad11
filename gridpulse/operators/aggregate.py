"""Grain-changing rollups. Sums combine map-side, so a hot key costs one
partial row per task; geometry text never travels through an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridpulse.functions.columns import (
    calendar, day_name, grand_total, pair_totals, rounded, safe_ratio,
)
from gridpulse.schemas import (
    ACTIVITY_COLUMNS, DECIMALS, FACT_MEASURES, HOURLY_COLUMNS, HOURLY_GRAIN, MEASURES,
)

KPI_SUMS = ["total_sms", "total_calls", "internet_activity", "total_activity"]


def _sums(columns, prefix: str = "", decimals: int | None = None):
    for c in columns:
        s = F.sum(c)
        yield (s if decimals is None else rounded(s, decimals)).alias(f"{prefix}{c}")


def hourly_grid(clean: DataFrame, decimals: int | None = DECIMALS) -> DataFrame:
    """Fold country codes away: one row per timestamp and grid cell.

    ``decimals=None`` leaves the sums unrounded.
    """
    summed = clean.groupBy(*HOURLY_GRAIN).agg(*_sums(MEASURES, decimals=decimals))
    return (
        summed.withColumns(calendar()).withColumns(pair_totals(decimals)).withColumns(grand_total(decimals))
        .select(*HOURLY_COLUMNS)
    )


def with_day_names(df: DataFrame) -> DataFrame:
    """Replace the day number by the English day name."""
    return df.withColumn("day_of_week", day_name())


def grid_geometry(df: DataFrame) -> DataFrame:
    """One geometry per grid cell out of a frame that repeats it on every row.

    The distinct pairs collapse map-side with the text as a grouping key; only
    then is the smallest text per cell picked, from the few pairs left.
    """
    pairs = df.where(F.col("geometry").isNotNull()).select("grid_id", "geometry").distinct()
    return pairs.groupBy("grid_id").agg(F.min("geometry").alias("geometry"))


def hourly_grid_geo(enriched: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Hourly sums of six measures with the cell's geometry.

    Sums first, geometry joined last: an aggregate that carried the text would
    have to sort every input row. The geometry comes from the lookup, one row
    per cell; only without one is it gathered from the rows.
    """
    from gridpulse.operators.enrich import attach_geometry

    summed = enriched.groupBy(*HOURLY_GRAIN).agg(*_sums(FACT_MEASURES, decimals=DECIMALS))
    source = grid_geometry(enriched) if lookup is None else lookup
    return attach_geometry(summed, source).select(*ACTIVITY_COLUMNS)


def daily_kpi(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("date").agg(*_sums(KPI_SUMS))


def grid_kpi(hourly: DataFrame) -> DataFrame:
    """Per-cell sums and the internet share, null for a cell without activity."""
    return (
        hourly.groupBy("grid_id").agg(*_sums(KPI_SUMS))
        .withColumn("internet_share", safe_ratio("internet_activity", "total_activity"))
    )


def grid_performance(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("grid_id").agg(*_sums(FACT_MEASURES, prefix="window_"))


def temporal_performance(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("timestamp").agg(
        F.sum("total_activity").alias("timestamp_total_activity")
    )


def top_grids(hourly: DataFrame, metric: str = "total_activity", n: int = 10,
              out: str | None = None, decimals: int | None = None) -> DataFrame:
    """The n cells with the largest sum; ties go to the smaller cell id."""
    out = out or metric
    s = F.sum(metric)
    summed = hourly.groupBy("grid_id").agg(
        (s if decimals is None else rounded(s, decimals)).alias(out)
    )
    return summed.orderBy(F.col(out).desc(), F.col("grid_id")).limit(n)


def top_grids_geo(hourly: DataFrame, lookup: DataFrame, n: int = 10) -> DataFrame:
    """Top cells with geometry: the join sees n rows on the left, not the facts."""
    from gridpulse.operators.enrich import attach_geometry

    return attach_geometry(top_grids(hourly, n=n, decimals=DECIMALS), lookup)


# --------------------------------------------------------------------------
# coverage and counts of raw deliveries
# --------------------------------------------------------------------------

def file_summary(raw: DataFrame) -> DataFrame:
    """Rows, distinct cells and time range per source file.

    Pre-aggregated on (file, cell) so a file holding most rows is still spread
    over its cells; the second step sees one row per pair.
    """
    per_cell = raw.groupBy("source_filename", "grid_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("lo"),
        F.max("timestamp").alias("hi"),
    )
    return per_cell.groupBy("source_filename").agg(
        F.sum("n").alias("rows"),
        F.count("grid_id").alias("unique_grids"),
        F.min("lo").alias("min_timestamp"),
        F.max("hi").alias("max_timestamp"),
    )


def date_coverage(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col("timestamp").isNotNull())
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def hour_coverage(df: DataFrame) -> DataFrame:
    """One row: hours seen, hours missing of 0..23, and whether all are there.

    Grouping by hour first leaves at most 24 rows to collect into the lists.
    """
    hours = (
        df.where(F.col("timestamp").isNotNull())
        .groupBy(F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    )
    seen = hours.agg(F.sort_array(F.collect_list("hour")).alias("seen"))
    day = F.sequence(F.lit(0), F.lit(23))
    missing = F.array_except(day, F.col("seen"))
    as_text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return seen.select(
        F.size("seen").cast("bigint").alias("hour_count"),
        as_text(F.col("seen")).alias("hours_seen"),
        as_text(missing).alias("hours_missing"),
        (F.size(missing) == 0).alias("complete"),
    )


def distinct_counts(df: DataFrame, columns, null_is_value: bool = False) -> DataFrame:
    """One row of distinct counts, ``unique_<column>``.

    With ``null_is_value`` a null counts as one more value. Catalyst expands
    the rows per column and removes repeats map-side before the shuffle.
    """
    def one(c):
        n = F.count_distinct(F.col(c))
        if null_is_value:
            n = n + F.max(F.col(c).isNull().cast("int"))
        return n.cast("bigint").alias(f"unique_{c}")

    return df.agg(*[one(c) for c in columns])


def range_and_count(df: DataFrame, columns) -> DataFrame:
    """Smallest, largest and number of distinct values, one row per column."""
    aggs = []
    for c in columns:
        aggs += [
            F.min(c).cast("string").alias(f"{c}__min"),
            F.max(c).cast("string").alias(f"{c}__max"),
            F.count_distinct(c).alias(f"{c}__n"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__min").alias("min_value"),
            F.col(f"{c}__max").alias("max_value"),
            F.col(f"{c}__n").alias("distinct_values"),
        )
        for c in columns
    ])
    return df.agg(*aggs).select(F.inline(rows))
