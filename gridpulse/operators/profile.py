"""Profiling: nulls, statistics, duplicates and totals, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridpulse.functions.columns import grand_total, null_count, pair_totals, percent_of
from gridpulse.operators.clean import fill_measures
from gridpulse.operators.quantiles import exact_quantiles
from gridpulse.schemas import MEASURES, TOTALS


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Null and non-null count and null percentage, one row per column."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[null_count(c).alias(f"_null_{c}") for c in columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{c}").alias("null_count"))
        for c in columns
    ])
    return wide.select("_rows", F.inline(rows)).select(
        "column_name",
        "null_count",
        (F.col("_rows") - F.col("null_count")).alias("non_null_count"),
        percent_of("null_count", F.col("_rows")).alias("null_percentage"),
    )


def null_totals(df: DataFrame, columns=None) -> DataFrame:
    """One row: nulls over all listed columns together."""
    columns = list(columns or df.columns)
    return df.agg(sum((null_count(c) for c in columns[1:]), null_count(columns[0])).alias("total_nulls"))


def measure_stats(df: DataFrame, columns=MEASURES) -> DataFrame:
    """count, mean, sample std, min, median and max of each column, nulls aside.

    The exact median takes counting passes, so ``df`` should be a stored table.
    """
    columns = list(columns)
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"), F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    rows = F.array(*[
        F.struct(F.lit(c).alias("metric"), *[
            F.col(f"{c}__{s}").alias(s) for s in ("count", "mean", "std", "min", "max")
        ])
        for c in columns
    ])
    stats = df.agg(*aggs).select(F.inline(rows))
    medians = exact_quantiles(df, {c: [0.5] for c in columns})
    median = F.element_at(F.create_map(*[
        x for c in columns for x in (F.lit(c), F.lit(medians[c, 0.5]).cast("double"))
    ]), F.col("metric"))
    return stats.select("metric", "count", "mean", "std", "min", median.alias("median"), "max")


def activity_totals_row(df: DataFrame) -> DataFrame:
    """One row: total_sms, total_calls and total_activity; nulls count as zero."""
    filled = fill_measures(df).withColumns(pair_totals()).withColumns(grand_total())
    return filled.agg(*[F.sum(c).alias(c) for c in TOTALS])


def activity_ranges(df: DataFrame) -> DataFrame:
    """min, max and mean of the measures and totals, one row per column.

    Measures are profiled as delivered (nulls aside); totals treat null as zero.
    """
    zeroed = df.select("*", *[F.coalesce(F.col(m), F.lit(0.0)).alias(f"_z_{m}") for m in MEASURES])
    z = {m: F.col(f"_z_{m}") for m in MEASURES}
    totals = {
        "total_sms": z["sms_in"] + z["sms_out"],
        "total_calls": z["call_in"] + z["call_out"],
    }
    full = zeroed.withColumns(totals).withColumn(
        "total_activity", F.col("total_sms") + F.col("total_calls") + z["internet_activity"]
    )
    columns = [*MEASURES, *TOTALS]
    aggs = [f(c).alias(f"{c}__{n}") for c in columns
            for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    rows = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"), F.col(f"{c}__mean").alias("mean"))
        for c in columns
    ])
    return full.agg(*aggs).select(F.inline(rows))


def duplicate_summary(df: DataFrame, keys=None) -> DataFrame:
    """One row: rows beyond the first per key, and keys that occur more than once.

    Nulls are equal to each other. Copies collapse map-side, so a key that
    holds a large share of the rows costs one partial row per task.
    """
    keys = list(keys or df.columns)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
    )


def duplicate_groups(df: DataFrame, keys) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def table_size(df: DataFrame) -> DataFrame:
    """One row: rows, columns and physical partitions that hold rows."""
    return df.groupBy(F.spark_partition_id().alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.count(F.lit(1)).alias("partition_count"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc(), F.col(column)
    )
