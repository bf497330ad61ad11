"""Exact interpolated quantiles by counting, for any number of rows.

A built-in exact percentile keeps every distinct value in one aggregation
buffer. Here a pass counts rows per bucket of a code that never decreases as
the value grows, and the buckets that hold the wanted ranks become the next
brackets: first 1,024 buckets per power of two, then a linear split of each
bracket, and the distinct values themselves once a bracket holds few rows. A
pass shuffles bucket counts, never values; a hot value is one bucket row per
task; and two rows per quantile return to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKETS_PER_OCTAVE = 1024
LINEAR_SPLITS = 2**20
# a bracket with at most this many rows is counted by distinct value
VALUE_ROWS = 1_000_000
_EXPONENT_ZERO = 1100.0   # above -log2 of the smallest double, keeps codes positive
_INFINITE = 2.0**60       # beyond any finite code


@dataclass(frozen=True)
class Bracket:
    """Values in [low, high] of one metric; ``before`` rows sort ahead of it."""

    metric: str
    low: float
    high: float
    before: int
    rows: int


def order_code(v: Column) -> Column:
    """A whole number, as double, that never decreases as ``v`` grows."""
    size = F.abs(v)
    code = F.floor((F.log2(size) + F.lit(_EXPONENT_ZERO)) * F.lit(float(BUCKETS_PER_OCTAVE))).cast("double")
    code = F.when(size == F.lit(float("inf")), F.lit(_INFINITE)).otherwise(code)
    return F.when(v == 0, F.lit(0.0)).when(v > 0, code).otherwise(-code)


def _count_buckets(rows: DataFrame, wanted: dict[int, list[int]], starts: dict[int, int]) -> list:
    """Buckets of (slot, code, v) rows that hold a wanted rank of their slot."""
    counts = rows.groupBy("slot", "code").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    ahead = W.partitionBy("slot").orderBy("code").rowsBetween(W.unboundedPreceding, -1)
    start = F.element_at(F.create_map(*[F.lit(x) for s in starts.items() for x in s]), F.col("slot"))
    ranked = counts.withColumn("before", start + F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    ranks = F.element_at(
        F.create_map(*[x for s, r in wanted.items()
                       for x in (F.lit(s), F.array(*[F.lit(int(k)) for k in r]))]),
        F.col("slot"))
    holds = F.exists(ranks, lambda k: (k >= F.col("before")) & (k < F.col("before") + F.col("n")))
    return ranked.where(holds).collect()


def _first_brackets(typed: DataFrame, metrics: list[str], totals: dict[str, int],
                    ranks: dict[str, list[int]]) -> list[Bracket]:
    slots = {m: i for i, m in enumerate(metrics) if totals[m]}
    if not slots:
        return []
    long = typed.unpivot([], list(slots), "metric", "v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    slot = F.element_at(F.create_map(*[F.lit(x) for s in slots.items() for x in s]), F.col("metric"))
    rows = long.select(slot.alias("slot"), order_code(F.col("v")).alias("code"), "v")
    hits = _count_buckets(rows, {i: ranks[m] for m, i in slots.items()}, {i: 0 for i in slots.values()})
    return [Bracket(metrics[r.slot], r.low, r.high, r.before, r.n) for r in hits]


def _narrow(typed: DataFrame, brackets: list[Bracket], ranks: dict[str, list[int]]) -> list[Bracket]:
    """One pass over the rows inside the given brackets."""
    def entry(i: int, b: Bracket) -> Column:
        v = F.col(b.metric)
        if b.rows <= VALUE_ROWS:
            code = v
        else:
            share = (v - F.lit(b.low)) / F.lit(b.high - b.low)
            code = F.floor(share * F.lit(float(LINEAR_SPLITS))).cast("double")
        inside = v.between(b.low, b.high)
        return F.when(inside, F.struct(F.lit(i).alias("slot"), code.alias("code"), v.alias("v")))

    inside_any = None
    for b in brackets:
        c = F.col(b.metric).between(b.low, b.high)
        inside_any = c if inside_any is None else inside_any | c
    entries = F.array_compact(F.array(*[entry(i, b) for i, b in enumerate(brackets)]))
    rows = typed.where(inside_any).select(F.inline(entries))
    wanted = {i: [k for k in ranks[b.metric] if b.before <= k < b.before + b.rows]
              for i, b in enumerate(brackets)}
    hits = _count_buckets(rows, wanted, {i: b.before for i, b in enumerate(brackets)})
    return [Bracket(brackets[r.slot].metric, r.low, r.high, r.before, r.n) for r in hits]


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[tuple[str, float], float | None]:
    """``{(metric, p): value}``, None for a metric without values.

    Null and NaN are left out. Interpolates linearly between the two
    neighbouring order statistics. Runs one job per pass, so ``df`` should be a
    stored table (see ``sources.scratch.cut``).
    """
    metrics = list(wanted)
    typed = _typed(df, metrics)
    counted = typed.agg(*[
        F.count_if(F.col(m).isNotNull() & ~F.isnan(m)).alias(m) for m in metrics
    ]).first()
    totals = {m: counted[m] for m in metrics}

    ranks = _ranks(totals, wanted)
    return _settled(wanted, totals, ranks, _first_brackets(typed, metrics, totals, ranks),
                    lambda brackets: _narrow(typed, brackets, ranks))


def _typed(df: DataFrame, metrics: list[str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])


def _ranks(totals: dict[str, int], wanted: dict[str, list[float]]) -> dict[str, list[int]]:
    return {m: sorted({k for p in wanted[m] for x in [(totals[m] - 1) * p] for k in (math.floor(x), math.ceil(x))})
            if totals[m] else [] for m in wanted}


def _settled(wanted: dict[str, list[float]], totals: dict[str, int], ranks: dict[str, list[int]],
             brackets: list[Bracket], narrow) -> dict[tuple[str, float], float | None]:
    """Narrow the brackets until each holds one value, then interpolate."""
    value: dict[tuple[str, int], float] = {}
    while brackets:
        still_open = []
        for b in brackets:
            if b.low == b.high:
                for k in ranks[b.metric]:
                    if b.before <= k < b.before + b.rows:
                        value[b.metric, k] = b.low
            else:
                still_open.append(b)
        brackets = narrow(still_open) if still_open else []

    result: dict[tuple[str, float], float | None] = {}
    for m in wanted:
        for p in wanted[m]:
            if not totals[m]:
                result[m, p] = None
                continue
            x = (totals[m] - 1) * p
            lo, hi = value[m, math.floor(x)], value[m, math.ceil(x)]
            result[m, p] = lo + (hi - lo) * (x - math.floor(x)) if hi != lo else lo
    return result


def value_histogram(df: DataFrame, metrics: list[str], by: str = "date") -> DataFrame:
    """(``by``, metric, code, n, low, high): values of each date counted by their order code.

    Histograms of dates add up, so a stored one spares the first pass over all
    rows; a date that changes brings its own rows anew. Null and NaN are left out.
    """
    long = _typed(df, metrics, by).unpivot([by], metrics, "metric", "v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    return long.groupBy(by, "metric", order_code(F.col("v")).alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def histogram_quantiles(histogram: DataFrame, df: DataFrame, wanted: dict[str, list[float]],
                        by: str = "date") -> dict[tuple[str, float], float | None]:
    """``exact_quantiles`` of ``df`` with the first pass read off its stored histogram.

    Later passes read only rows of dates whose histogram has values in an open
    bracket, and of these the rows inside it; both filters reach the scan.
    """
    metrics = list(wanted)
    counted = {r.metric: r.n for r in histogram.where(F.col("metric").isin(metrics)).groupBy("metric").agg(F.sum("n").alias("n")).collect()}
    totals = {m: counted.get(m, 0) for m in metrics}
    ranks = _ranks(totals, wanted)
    brackets = []
    for m in metrics:
        if totals[m]:
            one = histogram.where(F.col("metric") == m).groupBy("code").agg(
                F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
            ahead = W.orderBy("code").rowsBetween(W.unboundedPreceding, -1)
            # at most a few thousand codes per power of two that occurs, whatever the number of rows
            placed = one.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
            holds = F.exists(F.array(*[F.lit(k) for k in ranks[m]]), lambda k: (k >= F.col("before")) & (k < F.col("before") + F.col("n")))
            brackets += [Bracket(m, r.low, r.high, r.before, r.n) for r in placed.where(holds).collect()]

    def narrow(still_open: list[Bracket]) -> list[Bracket]:
        meets = [(F.col("metric") == b.metric) & (F.col("high") >= b.low) & (F.col("low") <= b.high) for b in still_open]
        any_of = meets[0]
        for c in meets[1:]:
            any_of = any_of | c
        dates = [r[0] for r in histogram.where(any_of).select(by).distinct().collect()]
        return _narrow(_typed(df.where(F.col(by).isin(dates)), metrics), still_open, ranks)

    return _settled(wanted, totals, ranks, brackets, narrow)
