"""Order-dependent operators that never put a whole table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridpulse.functions.columns import seconds_between


def previous_value(df: DataFrame, key: list[str], order: str, value: str, out: str,
                   chunk: Column | None = None) -> DataFrame:
    """Value of the previous row of the same key, in ``order``.

    Without ``chunk`` one window per key: right where the grain bounds a key,
    as in the hourly grid (a cell has at most one row per hour).

    With ``chunk`` (a column that grows with ``order``, such as the date) the
    window runs per key and chunk, and the first row of a chunk takes the last
    value of the nearest earlier chunk. A hot key, or no key at all, is then
    spread over its chunks; only one row per chunk meets in the second window.
    """
    if chunk is None:
        w = W.partitionBy(*key).orderBy(order)
        return df.withColumn(out, F.lag(value).over(w))

    rows = df.withColumn("_chunk", chunk)
    inner = W.partitionBy(*key, "_chunk").orderBy(order)
    marked = rows.withColumns({
        out: F.lag(value).over(inner),
        "_first": F.row_number().over(inner) == 1,
    })
    # a struct keeps a null value apart from "no earlier chunk"
    tails = rows.groupBy(*key, "_chunk").agg(
        F.max_by(F.struct(F.col(value).alias("v")), order).alias("_tail")
    )
    carried = tails.withColumn(
        "_carry", F.lag("_tail").over(W.partitionBy(*key).orderBy("_chunk"))
    )
    names = [*key, "_chunk"]
    right = carried.select(*[F.col(n).alias(f"_r{n}") for n in names], "_carry")
    on = [F.col(n).eqNullSafe(F.col(f"_r{n}")) for n in names]
    joined = marked.join(right, on, "left")
    return joined.withColumn(
        out, F.when(F.col("_first"), F.col("_carry.v")).otherwise(F.col(out))
    ).select(*df.columns, out)


def ordinal(df: DataFrame, levels: list[dict[str, Column]], order: list[str], out: str) -> DataFrame:
    """1-based global row number without a global sort.

    ``levels`` split the rows from coarse to fine, each level a set of named
    columns that sort ahead of the next. Row numbers run inside the finest
    groups; what precedes a group comes from prefix sums of group sizes, taken
    level by level, so the only window without a key runs over one row per
    coarsest group. Nulls sort first, on every level and in ``order``, and a
    row with a null level is numbered like any other.
    """
    named = {n: c for level in levels for n, c in level.items()}
    rows = df.withColumns(named)
    sizes = rows.groupBy(*named).agg(F.count(F.lit(1)).alias("_n"))

    def joined(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
        right = right.withColumnsRenamed({n: f"_r{n}" for n in names})
        on = [F.col(n).eqNullSafe(F.col(f"_r{n}")) for n in names]
        return left.join(right, on).drop(*[f"_r{n}" for n in names])

    # the finest level is a window over the sizes themselves; a coarser level
    # is summed up first and joined back on its few keys
    offsets, prefix, steps = sizes, [], []
    for level in levels:
        names, step = list(level), f"_before_{len(prefix)}"
        w = W.partitionBy(*prefix).orderBy(*names).rowsBetween(W.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(w), F.lit(0))
        finest = [*prefix, *names] == list(named)
        if finest:
            offsets = offsets.withColumn(step, before)
        else:
            counts = sizes.groupBy(*prefix, *names).agg(F.sum("_n").alias("_n"))
            offsets = joined(offsets, counts.withColumn(step, before).drop("_n"), [*prefix, *names])
        prefix, steps = [*prefix, *names], [*steps, step]
    offset = sum((F.col(s) for s in steps[1:]), F.col(steps[0]))
    offsets = offsets.select(*prefix, offset.alias("_offset"))
    numbered = rows.withColumn("_rn", F.row_number().over(W.partitionBy(*prefix).orderBy(*order)))
    return (
        joined(numbered, offsets, prefix)
        .withColumn(out, F.col("_offset") + F.col("_rn"))
        .select(*df.columns, out)
    )


def timestamp_gaps(df: DataFrame, step_seconds: int = 3600) -> DataFrame:
    """Neighbouring distinct timestamps that are not ``step_seconds`` apart.

    The lag runs per date and is carried across dates, so only one row per date
    is ever ordered globally.
    """
    stamps = df.where(F.col("timestamp").isNotNull()).select("timestamp").distinct()
    lagged = previous_value(
        stamps, [], "timestamp", "timestamp", "previous_timestamp",
        chunk=F.to_date("timestamp"),
    )
    diff = seconds_between("previous_timestamp", "timestamp")
    return (
        lagged.where(F.col("previous_timestamp").isNotNull())
        .withColumn("diff_seconds", diff)
        .where(F.col("diff_seconds") != step_seconds)
    )
