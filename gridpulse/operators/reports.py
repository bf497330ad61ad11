"""The five warehouse reports, and the run-status record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridpulse.operators.star import orphan_rows

def leading_cells(fact: DataFrame, metric: str, out: str, n: int = 10, decimals: int = 2) -> DataFrame:
    """The ``n`` cells with the largest rounded sum of a metric; ties go to the smaller cell."""
    total = F.round(F.sum(metric), decimals).alias(out)
    return fact.groupBy("grid_id").agg(total).orderBy(F.desc(out), "grid_id").limit(n)


def with_time(rows: DataFrame, times: DataFrame, *columns: str) -> DataFrame:
    """Rows under ``time_id`` with columns of the time dimension; unknown keys drop."""
    return rows.join(times.select("time_id", *columns), "time_id")


def by_hour(fact: DataFrame, times: DataFrame, metrics=("total_activity", "internet_activity"), decimals: int = 2) -> DataFrame:
    """Sums of metrics per hour of day, in order.

    Facts are summed per time key first, so the join moves keys, not facts.
    """
    per_key = fact.groupBy("time_id").agg(*[F.sum(m).alias(m) for m in metrics])
    placed = with_time(per_key, times, "hour").groupBy("hour")
    return placed.agg(*[F.round(F.sum(m), decimals).alias(m) for m in metrics]).orderBy("hour")


def leading_windows(fact: DataFrame, times: DataFrame, metric: str = "internet_activity", n: int = 10, decimals: int = 2) -> DataFrame:
    """The ``n`` (time, cell) rows with the largest value of a metric, shown with the total activity.

    Ties go to the earlier time, then the smaller cell. Time keys are numbered
    in time order, so the rows are cut to ``n`` before they meet the dimension.
    """
    known = fact.join(times.select("time_id"), "time_id", "left_semi")
    order = (F.desc(metric), F.col("time_id"), F.col("grid_id"))
    top = with_time(known.orderBy(*order).limit(n), times, "timestamp").orderBy(*order)
    return top.select("timestamp", "grid_id", *[F.round(m, decimals).alias(m) for m in (metric, "total_activity")])


def joined_rows(fact: DataFrame, times: DataFrame, grids: DataFrame) -> DataFrame:
    """One row: facts that find both of their dimension rows."""
    found = fact.join(times.select("time_id"), "time_id").join(grids.select("grid_id"), "grid_id")
    return found.agg(F.count(F.lit(1)).alias("joined_rows"))


# Ledger states that count as a rejected delivery.
REJECTED_STATES = ["REJECTED", "REJECTED_DUPLICATE"]


def rejected_files(ledger: DataFrame) -> DataFrame:
    """One row: ledger entries of rejected deliveries, over all runs."""
    return ledger.where(F.col("status").isin(*REJECTED_STATES)).agg(
        F.count(F.lit(1)).alias("files_rejected")
    )


def as_of(fact: DataFrame, times: DataFrame) -> DataFrame:
    """One row: latest timestamp any fact row refers to.

    Only the distinct time keys of the facts meet the dimension.
    """
    used = fact.select("time_id").distinct()
    return used.join(times.select("time_id", "timestamp"), "time_id").agg(
        F.max("timestamp").alias("as_of")
    )


def table_status(fact: DataFrame, times: DataFrame, grids: DataFrame,
                 ledger: DataFrame) -> DataFrame:
    """One row: published rows, dimension sizes, orphans, as-of, rejected files."""
    def one(df):
        return df.scalar()

    count = F.count(F.lit(1))
    return fact.agg(count.alias("rows_published")).select(
        "rows_published",
        one(times.agg(count)).alias("dim_time_rows"),
        one(grids.agg(count)).alias("dim_grid_rows"),
        F.col("rows_published").alias("fact_rows"),
        one(orphan_rows(fact, times, "time_id")).alias("orphan_time_keys"),
        one(orphan_rows(fact, grids, "grid_id")).alias("orphan_grid_keys"),
        one(as_of(fact, times)).alias("as_of"),
        one(rejected_files(ledger)).alias("files_rejected"),
    )


def run_status(status: DataFrame, clean_metrics: dict, run_id: str, tasks: dict[str, str]) -> DataFrame:
    """The run record: table facts plus what this run read, rejected and filled.

    The status is SUCCESS only when every task says so and no orphan is left.
    """
    ok = all(v == "SUCCESS" for v in tasks.values())
    sound = (F.col("orphan_time_keys") == 0) & (F.col("orphan_grid_keys") == 0)
    return status.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("run_timestamp"),
        F.when(F.lit(ok) & sound, "SUCCESS").otherwise("FAILED").alias("status"),
        F.struct(*[F.lit(v).alias(k) for k, v in tasks.items()]).alias("tasks"),
        F.lit(clean_metrics["input_rows"]).cast("bigint").alias("rows_in"),
        F.lit(clean_metrics["rejected_rows"]).cast("bigint").alias("rows_rejected"),
        F.lit(clean_metrics["nulls_handled"]).cast("bigint").alias("nulls_handled"),
        "rows_published", "as_of", "dim_time_rows", "dim_grid_rows", "fact_rows",
        "orphan_time_keys", "orphan_grid_keys", "files_rejected",
    )
