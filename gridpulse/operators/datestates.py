"""Facts per date that add up to facts over all dates.

A timestamp belongs to one date, so counts, key counts, extremes, distinct
timestamps and reconciled keys of a table are those of its dates put together.
One state row per date is kept beside a table; a run makes the rows of the
dates it changed and reads no detail of the others. Distinct ids, which dates
share, are bitmaps that are united by bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridpulse.operators import checks
from gridpulse.operators.checks import Rules
from gridpulse.operators.compare import DECIMALS, _reconciled
from gridpulse.schemas import HOURLY_GRAIN


def rule_states(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per ``date``: what the rules of a table need to know of it.

    The grain must hold the timestamp, and ``date`` must be the timestamp's. ``key_print`` is
    a sum of hashes of the distinct keys, the same for equal key sets in any order.
    """
    one = F.lit(1)
    aggs = {"rows": F.count(one)}
    aggs |= {f"null_{c}": F.count_if(F.col(c).isNull()) for c in rules.not_null}
    aggs |= {f"neg_{c}": F.count_if(F.col(c) < 0) for c in rules.non_negative}
    aggs |= {f"odd_{c}": F.count_if(F.isnan(c) | (F.abs(c) == float("inf"))) for c in rules.finite}
    aggs["hours"] = F.bit_or(F.call_function("shiftleft", one, F.hour("timestamp")))
    if rules.id_range:
        aggs |= {"low_id": F.min(rules.id_range[0]), "high_id": F.max(rules.id_range[0])}
    wide = df.groupBy("date").agg(*[v.alias(k) for k, v in aggs.items()])
    per_key = df.groupBy("date", *rules.grain).agg(F.count(one).alias("_n"))
    # a hash of 64 bits times any number of keys stays far below 38 digits
    keys = per_key.groupBy("date").agg(
        F.count(one).alias("keys"), F.count_if(F.col("_n") > 1).alias("dup_groups"),
        F.sum(F.xxhash64(*rules.grain).cast("decimal(20,0)")).cast("string").alias("key_print"))
    stamps = df.select("date", "timestamp").distinct().groupBy("date").agg(F.count("timestamp").alias("stamps"))
    return wide.join(keys, "date").join(stamps, "date")


def state_checks(states: DataFrame, dataset: str, rules: Rules, columns: list[str],
                 distinct_ids: DataFrame | None = None) -> DataFrame:
    """The check rows of ``checks.table_checks``, from the state rows of all dates.

    ``columns`` are those of the table; ``distinct_ids`` has one row and a column ``unique_<id>``.
    Distinct values can be asked of the timestamp only.
    """
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    def equal(name: str, observed: Column, expected) -> Column:
        return checks._equal(name, observed, expected)

    names = ["rows", "keys", "dup_groups", "stamps", *[f"null_{c}" for c in rules.not_null],
             *[f"neg_{c}" for c in rules.non_negative], *[f"odd_{c}" for c in rules.finite]]
    aggs = [total(n).alias(n) for n in names]
    aggs += [F.bit_count(F.coalesce(F.bit_or("hours"), F.lit(0))).alias("hours"), F.count_if(F.col("rows") > 0).alias("dates")]
    if rules.id_range:
        aggs += [F.min("low_id").alias("low_id"), F.max("high_id").alias("high_id")]
    wide = states.agg(*aggs)
    if rules.id_range:
        wide = wide.withColumn("ids", distinct_ids.select(f"unique_{rules.id_range[0]}").scalar())

    rows, out = F.col("rows"), checks._schema_rows(columns, rules)
    out += [
        checks._row("not empty", rows > 0, rows, 1),
        equal("rows beyond first per key", rows - F.col("keys"), 0),
        equal("keys more than once", F.col("dup_groups"), 0),
    ]
    if rules.rows is not None:
        out.append(equal("exact row count", rows, rules.rows))
    if rules.max_rows is not None:
        out.append(checks._row("row bound", rows <= rules.max_rows, rows, rules.max_rows))
    if rules.fewer_rows_than is not None:
        out.append(checks._row("fewer rows than input", rows < rules.fewer_rows_than, rows, rules.fewer_rows_than))
    out += [equal(f"nulls in {c}", F.col(f"null_{c}"), 0) for c in rules.not_null]
    out += [equal(f"negatives in {c}", F.col(f"neg_{c}"), 0) for c in rules.non_negative]
    out += [equal(f"not finite in {c}", F.col(f"odd_{c}"), 0) for c in rules.finite]
    if set(rules.distinct) - {"timestamp"}:
        raise ValueError(f"dates share the values of {sorted(set(rules.distinct) - {'timestamp'})}")
    out += [equal(f"distinct {c}", F.col("stamps"), n) for c, n in rules.distinct.items()]
    if rules.all_hours:
        out.append(equal("hours of day seen", F.col("hours"), 24))
    if rules.distinct_dates is not None:
        out.append(equal("distinct dates", F.col("dates"), rules.distinct_dates))
    if rules.id_range:
        n = rules.id_range[1]
        out += [equal("smallest id", F.col("low_id"), 1), equal("largest id", F.col("high_id"), n), equal("distinct ids", F.col("ids"), n)]
    return wide.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*out)))


def reconcile_states(clean: DataFrame, hourly: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """``compare.reconcile`` per date."""
    both = (F.col("_d") > 0) & (F.col("_s") > 0)
    return _reconciled(clean, hourly, decimals).groupBy(F.to_date(HOURLY_GRAIN[0]).alias("date")).agg(
        F.count(F.lit(1)).alias("reconciled_keys"),
        F.count_if(F.col("_s") == 0).alias("missing_in_hourly"),
        F.count_if(F.col("_d") == 0).alias("missing_in_detail"),
        F.count_if(F.col("_s") > 1).alias("stored_more_than_once"),
        F.count_if(both & F.col("_differs")).alias("mismatched_keys"),
    )


def file_states(rows: DataFrame) -> DataFrame:
    """Rows and clean rows per delivered file and date; rejected rows without a timestamp have no date."""
    return rows.groupBy("source_filename", "date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("row_status") == "clean").alias("clean_rows"))


def second_of(timestamp: str) -> Column:
    """Whole seconds of a wall-clock time since 1970, as an id."""
    t = F.col(timestamp)
    day = F.unix_date(F.to_date(t)).cast("bigint")
    return ((day * 24 + F.hour(t)) * 60 + F.minute(t)) * 60 + F.second(t)


def id_bitmaps(df: DataFrame, ids: dict[str, Column], by: str = "date") -> DataFrame:
    """(``by``, column_name, bucket, bitmap): the ids of each column that a date holds, one bit per id.

    For ids of a bounded range: a bucket holds 32,768 neighbouring ids in 4 KB. Every column is an
    aggregate of its own that reads only that column; nulls are no ids.
    """
    def one(name: str, value: Column) -> DataFrame:
        value = value.cast("bigint")
        return df.select(by, value.alias("_v")).where(F.col("_v").isNotNull()).groupBy(
            by, F.lit(name).alias("column_name"), F.bitmap_bucket_number("_v").alias("bucket")
        ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias("bitmap"))

    parts = [one(n, c) for n, c in ids.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bitmap_counts(bitmaps: DataFrame, columns: list[str]) -> DataFrame:
    """One row of distinct counts ``unique_<column>`` over all dates of the bitmaps."""
    united = bitmaps.groupBy("column_name", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    n = F.bitmap_count("bitmap")
    return united.agg(*[
        F.coalesce(F.sum(F.when(F.col("column_name") == c, n)), F.lit(0)).cast("bigint").alias(f"unique_{c}") for c in columns])


def time_offsets(states: DataFrame) -> DataFrame:
    """(date, before): distinct timestamps of all earlier dates. One row per date, so its window is one small task."""
    earlier = W.orderBy("date").rowsBetween(W.unboundedPreceding, -1)
    return states.select("date", F.coalesce(F.sum("stamps").over(earlier), F.lit(0)).alias("before"))
