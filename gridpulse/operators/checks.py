"""Data-quality checks as a result table.

Each check is one row ``(dataset, check_name, passed, observed, expected)``.
Row-level rules (nulls, signs, counts) share one aggregate without a shuffle.
Uniqueness shuffles the grain and a count, nothing else; distinct counts read
their own column. Those enter as scalar subqueries, so a stored table is read
column by column and wide rows never travel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.schemas import missing_columns

CHECK_COLUMNS = ["dataset", "check_name", "passed", "observed", "expected"]


@dataclass
class Rules:
    """What a dataset must satisfy; expected sizes always come from the caller."""

    grain: list[str]
    required: list[str] = field(default_factory=list)
    exact: list[str] | None = None
    forbidden: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    non_negative: list[str] = field(default_factory=list)
    finite: list[str] = field(default_factory=list)
    rows: int | Column | None = None
    max_rows: int | Column | None = None
    fewer_rows_than: int | Column | None = None
    distinct: dict[str, int | Column] = field(default_factory=dict)
    all_hours: bool = False
    distinct_dates: int | Column | None = None
    id_range: tuple[str, int] | None = None


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _row(name: str, passed: Column, observed: Column, expected) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        _as_col(expected).cast("double").alias("expected"),
    )


def _equal(name, observed, expected):
    return _row(name, observed == _as_col(expected), observed, expected)


def _schema_rows(columns: list[str], rules: Rules) -> list[Column]:
    out = []
    if rules.required:
        gone = len(missing_columns(columns, rules.required))
        out.append(_equal("required columns missing", F.lit(gone), 0))
    if rules.exact is not None:
        same = int(list(columns) == list(rules.exact))
        out.append(_equal("exact ordered columns", F.lit(same), 1))
    if rules.forbidden:
        here = sum(c in columns for c in rules.forbidden)
        out.append(_equal("forbidden columns present", F.lit(here), 0))
    return out


def table_checks(df: DataFrame, dataset: str, rules: Rules) -> DataFrame:
    """Run every rule of one dataset; ``df`` should be a stored table."""
    one = F.lit(1)
    aggs = {"rows": F.count(one)}
    aggs |= {f"_null_{c}": F.count_if(F.col(c).isNull()) for c in rules.not_null}
    aggs |= {f"_neg_{c}": F.count_if(F.col(c) < 0) for c in rules.non_negative}
    aggs |= {f"_odd_{c}": F.count_if(F.isnan(c) | (F.abs(c) == float("inf"))) for c in rules.finite}
    wide = df.agg(*[v.alias(k) for k, v in aggs.items()])

    sizes = df.groupBy(*rules.grain).agg(F.count(one).alias("_n"))
    parts = {"_keys": sizes.agg(F.struct(
        F.count(one).alias("keys"), F.count_if(F.col("_n") > 1).alias("dup_groups")))}
    for c in rules.distinct:
        parts[f"_of_{c}"] = df.select(c).distinct().agg(F.struct(F.count(c).alias("n")))
    if rules.all_hours or rules.distinct_dates is not None:
        stamps = df.select("timestamp").distinct()
        parts["_time"] = stamps.agg(F.struct(
            F.count_distinct(F.hour("timestamp")).alias("hours"),
            F.count_distinct(F.to_date("timestamp")).alias("dates")))
    if rules.id_range:
        c = rules.id_range[0]
        parts["_ids"] = df.select(c).distinct().agg(F.struct(
            F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("n")))
    wide = wide.withColumns({name: part.scalar() for name, part in parts.items()})

    rows = F.col("rows")
    checks = _schema_rows(df.columns, rules)
    checks += [
        _row("not empty", rows > 0, rows, 1),
        _equal("rows beyond first per key", rows - F.col("_keys.keys"), 0),
        _equal("keys more than once", F.col("_keys.dup_groups"), 0),
    ]
    if rules.rows is not None:
        checks.append(_equal("exact row count", rows, rules.rows))
    if rules.max_rows is not None:
        checks.append(_row("row bound", rows <= _as_col(rules.max_rows), rows, rules.max_rows))
    if rules.fewer_rows_than is not None:
        limit = _as_col(rules.fewer_rows_than)
        checks.append(_row("fewer rows than input", rows < limit, rows, limit))
    checks += [_equal(f"nulls in {c}", F.col(f"_null_{c}"), 0) for c in rules.not_null]
    checks += [_equal(f"negatives in {c}", F.col(f"_neg_{c}"), 0) for c in rules.non_negative]
    checks += [_equal(f"not finite in {c}", F.col(f"_odd_{c}"), 0) for c in rules.finite]
    checks += [
        _equal(f"distinct {c}", F.col(f"_of_{c}.n"), n) for c, n in rules.distinct.items()
    ]
    if rules.all_hours:
        checks.append(_equal("hours of day seen", F.col("_time.hours"), 24))
    if rules.distinct_dates is not None:
        checks.append(_equal("distinct dates", F.col("_time.dates"), rules.distinct_dates))
    if rules.id_range:
        n = rules.id_range[1]
        checks += [
            _equal("smallest id", F.col("_ids.low"), 1),
            _equal("largest id", F.col("_ids.high"), n),
            _equal("distinct ids", F.col("_ids.n"), n),
        ]
    return wide.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*checks)))


def schema_checks(df: DataFrame, dataset: str, rules: Rules) -> DataFrame:
    """The rules about columns alone; no row of ``df`` is read."""
    one = df.sparkSession.range(1)
    return one.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*_schema_rows(df.columns, rules))))


def reference_checks(features: DataFrame, dataset: str, expected_cells: int | None = None) -> DataFrame:
    """Checks of a feature table ``(document_type, cell_id text, geometry)``."""
    ids = F.col("cell_id").try_cast("bigint")
    per_id = features.groupBy(ids.alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("document_type").eqNullSafe("FeatureCollection")).alias("_typed"),
        F.count_if(F.col("cell_id").isNull()).alias("_no_id"),
        F.count_if(F.col("cell_id").isNotNull() & ids.isNull()).alias("_not_int"),
        F.count_if(F.col("geometry").isNull()).alias("_no_geometry"),
    )
    zero = F.lit(0)
    named = F.col("_id").isNotNull()
    wide = per_id.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("_n", "_typed", "_no_id", "_not_int", "_no_geometry")],
        F.count_if(named).alias("_cells"),
        F.count_if(named & (F.col("_n") > 1)).alias("_repeated"),
    )
    n = F.col("_n")
    checks = [
        _row("not empty", n > 0, n, 1),
        _equal("features outside a collection", n - F.col("_typed"), 0),
        _equal("missing ids", F.col("_no_id"), 0),
        _equal("ids not integer", F.col("_not_int"), 0),
        _equal("ids more than once", F.col("_repeated"), 0),
        _equal("missing geometry", F.col("_no_geometry"), 0),
    ]
    if expected_cells is not None:
        checks.append(_equal("distinct ids", F.col("_cells"), expected_cells))
    return wide.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*checks)))


def cadence_check(raw: DataFrame, file: str = "source_filename", hours_per_file: int = 24) -> DataFrame:
    """Distinct timestamps equal files times hours per file."""
    pairs = raw.select(file, "timestamp").distinct()
    wide = pairs.agg(
        F.count_distinct("timestamp").alias("stamps"), F.count_distinct(file).alias("files")
    )
    return wide.select(F.lit("clean").alias("dataset"), F.inline(F.array(
        _equal("timestamp cadence", F.col("stamps"), F.col("files") * hours_per_file))))


def file_count_check(raw: DataFrame, expected_files: int, file: str = "source_filename") -> DataFrame:
    wide = raw.agg(F.count_distinct(file).alias("files"))
    return wide.select(F.lit("raw").alias("dataset"), F.inline(F.array(
        _equal("source files", F.col("files"), expected_files))))


def invalid_timestamps(raw_text: DataFrame, parsed) -> DataFrame:
    """One row: text present but not a timestamp, and rows without text.

    ``raw_text`` still has the delivered ``datetime``; ``parsed`` is its
    coerced form as a Column.
    """
    blank = F.trim(F.coalesce("datetime", F.lit(""))) == ""
    return raw_text.agg(
        F.count_if(~blank & parsed.isNull()).alias("invalid_timestamps"),
        F.count_if(blank).alias("blank_timestamps"),
    )


def value_check(df: DataFrame, dataset: str, name: str, column: str, expected) -> DataFrame:
    """Turn one column of a one-row result into a check row."""
    return df.select(F.lit(dataset).alias("dataset"), F.inline(F.array(
        _equal(name, F.col(column), expected))))


def flag_check(df: DataFrame, dataset: str, name: str, flag: str) -> DataFrame:
    """Turn a boolean column of a one-row result into a check row."""
    return value_check(df.withColumn("_flag", F.col(flag).cast("int")), dataset, name, "_flag", 1)


def gap_check(gaps: DataFrame, dataset: str = "hourly grid") -> DataFrame:
    n = gaps.agg(F.count(F.lit(1)).alias("gaps"))
    return value_check(n, dataset, "gaps between timestamps", "gaps", 0)


def preserved_check(before: DataFrame, after: DataFrame, dataset: str, name: str) -> DataFrame:
    """Row counts of two frames agree; each side counts on its own columns."""
    count = F.count(F.lit(1))
    wide = after.agg(count.alias("after")).withColumn("before", before.agg(count).scalar())
    return value_check(wide, dataset, name, "after", F.col("before"))


def collect_checks(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*CHECK_COLUMNS)


class CheckFailed(ValueError):
    """Raised by :func:`enforce`; names every failed check."""


def enforce(checks: DataFrame) -> None:
    """Raise when any check failed. Brings back the failed check rows only."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.dataset}: {r.check_name} (observed {r.observed}, expected {r.expected})"
                 for r in failed]
        raise CheckFailed("; ".join(lines))
