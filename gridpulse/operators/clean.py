"""Raw delivery rows to the clean table. All steps are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.functions.columns import (
    any_of, calendar, grand_total, is_negative, pair_totals, parse_timestamp, rounded,
)
from gridpulse.schemas import (
    CANONICAL_NAMES, CLEAN_COLUMNS, DECIMALS, MEASURES, NAME_SYNONYMS, TOTALS, require_columns,
)

# Reject reasons in the order they are reported.
REJECT_REASONS = ["missing_timestamp", "missing_grid_id", "negative_activity"]


def canonical_names(df: DataFrame) -> DataFrame:
    """Rename the eight delivery columns to their canonical names."""
    return df.withColumnsRenamed(CANONICAL_NAMES)


def normal_name(name: str) -> str:
    """Canonical spelling of one free-form column name."""
    key = name.strip().lower()
    if key in NAME_SYNONYMS:
        return NAME_SYNONYMS[key]
    return key.translate(str.maketrans(" -/.", "____"))


def normalise_names(df: DataFrame) -> DataFrame:
    """Apply :func:`normal_name` to every column, in one projection."""
    return df.toDF(*[normal_name(c) for c in df.columns])


def coerce(df: DataFrame) -> DataFrame:
    """Cast to the declared types; unusable values become null.

    A cast to the type a column already has is removed by the optimizer, so
    typed input costs nothing here.
    """
    require_columns(df, ["timestamp", "grid_id", "country_code", *MEASURES], "raw rows")
    ts = F.col("timestamp")
    is_text = df.schema["timestamp"].dataType.simpleString() == "string"
    casts = {
        "timestamp": parse_timestamp(ts) if is_text else ts.cast("timestamp_ntz"),
        "grid_id": F.col("grid_id").try_cast("bigint"),
        "country_code": F.col("country_code").try_cast("bigint"),
        **{m: F.col(m).try_cast("double") for m in MEASURES},
    }
    return df.withColumns(casts)


def reject_tests() -> dict[str, Column]:
    """Reason -> condition over coerced rows; several may hold for one row."""
    return {
        "missing_timestamp": F.col("timestamp").isNull(),
        "missing_grid_id": F.col("grid_id").isNull(),
        "negative_activity": is_negative(),
    }


def is_rejected() -> Column:
    return any_of(reject_tests().values())


def kept(coerced: DataFrame) -> DataFrame:
    """Rows without any reason; a plain predicate, inside generated code."""
    return coerced.where(~is_rejected())


def with_reasons(coerced: DataFrame) -> DataFrame:
    """Add ``reject_reasons``: every reason that applies, empty for a clean row."""
    hits = F.array(*[F.when(test, F.lit(r)) for r, test in reject_tests().items()])
    return coerced.withColumn("reject_reasons", F.array_compact(hits))


def rejected(coerced: DataFrame) -> DataFrame:
    """The quarantined rows with their reasons."""
    return with_reasons(coerced.where(is_rejected()))


def reject_summary(coerced: DataFrame) -> DataFrame:
    """One row: counts per reason (a row may count in several), rejected, clean."""
    bad = is_rejected()
    return coerced.agg(
        F.count(F.lit(1)).alias("input_rows"),
        *[F.count_if(test).alias(r) for r, test in reject_tests().items()],
        F.count_if(bad).alias("rejected_rows"),
        F.count_if(~bad).alias("clean_rows"),
    )


def fill_measures(df: DataFrame) -> DataFrame:
    """Null measures become 0.0. NaN stays: the finite check reports it."""
    return df.withColumns({m: F.coalesce(F.col(m), F.lit(0.0)) for m in MEASURES})


def finish(df: DataFrame, round_rows: bool = True) -> DataFrame:
    """Null-fill, calendar fields, totals, rounding and the final projection."""
    out = fill_measures(df).withColumns(calendar()).withColumns(pair_totals()).withColumns(grand_total())
    if round_rows:
        out = out.withColumns({c: rounded(c, DECIMALS) for c in [*MEASURES, *TOTALS]})
    return out.select(*CLEAN_COLUMNS)


def clean(raw: DataFrame, round_rows: bool = True) -> DataFrame:
    """Delivery rows to the clean table at grain timestamp + grid + country."""
    return finish(kept(coerce(canonical_names(raw))), round_rows)


def finish_all(coerced: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean and rejected rows as one table, told apart by ``row_status``.

    Lets both be written in a single pass: partitioned by status and date, a
    reader of either side scans only its own files. Rejected rows keep their
    nulls, for whoever has to repair them.
    """
    clean_row = F.col("row_status") == "clean"
    status = F.when(is_rejected(), "rejected").otherwise("clean")
    filled = with_reasons(coerced).withColumn("row_status", status).withColumns({
        m: F.coalesce(F.col(m), F.when(clean_row, F.lit(0.0))) for m in MEASURES
    })
    full = filled.withColumns(calendar()).withColumns(pair_totals()).withColumns(grand_total())
    return full.withColumns({c: rounded(c, DECIMALS) for c in [*MEASURES, *TOTALS]}).select(
        "row_status", F.array_join("reject_reasons", ",").alias("reject_reasons"), *keep, *CLEAN_COLUMNS
    )
