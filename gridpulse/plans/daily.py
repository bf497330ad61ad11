"""The daily chain: landing files to published tables, checks and run record.

Every stage writes a table and the next one reads it, so a stage can be rerun
alone and no lineage grows across stages. Each table is written in one pass;
its counts ride on the write.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.functions.columns import parse_timestamp
from gridpulse.operators import (
    aggregate, alerts, checks, clean, compare, datestates, enrich, gate, ordering, profile, quantiles, reports, star,
)
from gridpulse.operators.checks import Rules
from gridpulse.schemas import (
    ACTIVITY_COLUMNS, CLEAN_COLUMNS, CLEAN_GRAIN, HOURLY_COLUMNS, HOURLY_GRAIN, MEASURES, TOTALS,
)
from gridpulse.sources.delimited import list_files, read_records
from gridpulse.sources.geojson import cell_lookup, read_features, require_cells
from gridpulse.sources.scratch import cut, scoped
from gridpulse.sources.sinks import read_ledger, verify, write_csv, write_zone
from gridpulse.sources.tables import present, read_table
from gridpulse.streaming.arrivals import Zones, ingest, ingest_new, read_raw


@dataclass(frozen=True)
class Expected:
    """Sizes the checks compare with; None leaves a check out."""

    files: int | None = None
    timestamps: int | None = None
    dates: int | None = None
    cells: int | None = None


@dataclass
class Run:
    """Where one run put its tables, and what it counted on the way."""

    root: str
    metrics: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


# published name -> zone
TABLES = {
    "processed/detail": "detail",
    "processed/hourly_grid": "processed",
    "processed/activity": "processed",
    "analytics/hourly_grid_summary": "analytics",
    "analytics/grid_performance": "analytics",
    "analytics/temporal_performance": "analytics",
    "analytics/daily_kpi": "analytics",
    "analytics/grid_kpi": "analytics",
    "analytics/alerts": "analytics",
    "warehouse/dim_time": "analytics",
    "warehouse/dim_grid": "analytics",
    # by date, with the number of the timestamp inside its date; ``read_fact`` gives the time keys
    "warehouse/fact_network_activity": "processed",
}

# facts per date beside the tables; a run replaces the dates it changed
STATES = {
    "states/detail": "processed",
    "states/hourly": "processed",
    "states/reconciled": "processed",
    "states/histogram": "processed",
    "states/ids": "processed",
    "states/files": "by_file",
    "states/deliveries": "by_file",
    "states/delivered_ids": "by_file",
}


def _publish(spark, run: Run, name: str, df: DataFrame, metrics=None, rebalance=False) -> DataFrame:
    run.metrics[name] = write_zone(df, run.path(name), TABLES[name], metrics, rebalance)
    return spark.read.parquet(run.path(name))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _state(spark: SparkSession, run: Run, name: str) -> DataFrame:
    return spark.read.parquet(run.path(f"states/{name}"))


def new_files(spark: SparkSession, run: Run, zones: Zones) -> list[str]:
    """Accepted files whose rows are not in all tables yet, by the states of files, which a run writes last.

    The list is as long as a run has new deliveries. A run that broke off is made up for by the next one.
    """
    accepted = read_ledger(spark, zones.ledger).where(F.col("status") == gate.ACCEPTED).select("filename").distinct()
    done = _state(spark, run, "files").select(F.col("source_filename").alias("filename")).distinct()
    return sorted(r.filename for r in accepted.join(done, "filename", "left_anti").collect())


def build_detail(spark: SparkSession, run: Run, text: DataFrame) -> DataFrame:
    """Rows of the raw zone to clean and rejected rows in one pass; returns all clean rows.

    Partitions of the files that ``text`` holds are replaced.
    """
    coerced = clean.coerce(clean.canonical_names(text))
    filled = sum((F.col(m).isNull().cast("int") for m in MEASURES[1:]), F.col(MEASURES[0]).isNull().cast("int"))
    counted = coerced.withColumn("_filled", F.when(clean.is_rejected(), 0).otherwise(filled))
    table = _publish(
        spark, run, "processed/detail", clean.finish_all(counted, ("source_filename", "_filled")),
        metrics={
            "rejected_rows": F.count_if(F.col("row_status") == "rejected"),
            "clean_rows": F.count_if(F.col("row_status") == "clean"),
            "nulls_handled": F.coalesce(F.sum("_filled"), F.lit(0)),
            **{r: F.count_if(F.contains("reject_reasons", F.lit(r))) for r in clean.REJECT_REASONS},
        },
    )
    return table.where(F.col("row_status") == "clean")


@dataclass(frozen=True)
class Changed:
    """The dates a run changed (None: all of them), and the files that hold rows of these dates."""

    dates: list | None
    files: list[str] | None

    def detail(self, detail: DataFrame) -> DataFrame:
        """Clean rows of the dates; files are partitions, so no other file is read."""
        if self.dates is None:
            return detail
        return detail.where(F.col("source_filename").isin(self.files) & F.col("date").isin(self.dates))

    def of(self, dated: DataFrame) -> DataFrame:
        return dated if self.dates is None else dated.where(F.col("date").isin(self.dates))


def changed_by(spark: SparkSession, run: Run, files: list[str] | None) -> tuple[Changed, DataFrame]:
    """What the stored rows of new files change, and the state rows of these files."""
    rows = spark.read.parquet(run.path("processed/detail"))
    fresh = cut(datestates.file_states(rows if files is None else rows.where(F.col("source_filename").isin(files))))
    if files is None:
        return Changed(None, None), fresh
    held = fresh.where("clean_rows > 0")
    dates = [r.date for r in held.select("date").distinct().collect()]
    known = _state(spark, run, "files").where("clean_rows > 0").select("source_filename", "date")
    sharing = held.select("source_filename", "date").unionByName(known).where(F.col("date").isin(dates))
    return Changed(dates, [r.source_filename for r in sharing.select("source_filename").distinct().collect()]), fresh


def build_activity(spark: SparkSession, run: Run, detail: DataFrame, lookup: DataFrame,
                   changed: Changed = Changed(None, None)) -> tuple[DataFrame, DataFrame]:
    """Hourly grid, and the same rows with geometry.

    Only changed dates are summed again, from the detail rows of all files with
    these dates, and replaced in both tables.
    """
    before = None if changed.dates is None else _stored(spark, run.path("processed/hourly_grid"))
    kept = 0 if before is None else before.where(~F.col("date").isin(changed.dates)).count()
    hourly = _publish(spark, run, "processed/hourly_grid", aggregate.hourly_grid(changed.detail(detail)), rebalance=True)
    run.metrics["processed/hourly_grid"] = {"rows": run.metrics["processed/hourly_grid"]["rows"] + kept}
    # the storage partition is the date, which the published columns leave out
    dated = enrich.enrich(changed.of(hourly), lookup).withColumn("date", F.to_date("timestamp"))
    activity = _publish(spark, run, "processed/activity", dated).select(*ACTIVITY_COLUMNS)
    run.metrics["processed/activity"] = {"rows": run.metrics["processed/activity"]["rows"] + kept}
    # one row per timestamp and cell already: summing again would change nothing
    _publish(spark, run, "analytics/hourly_grid_summary", activity)
    return hourly, activity


def build_states(spark: SparkSession, run: Run, detail: DataFrame, hourly: DataFrame, changed: Changed) -> None:
    """State rows of the changed dates; those of other dates stay as they are."""
    own, fresh = changed.detail(detail), changed.of(hourly)
    detail_rules, hourly_rules = table_rules()
    for name, df in {
        "detail": datestates.rule_states(own, detail_rules),
        "hourly": datestates.rule_states(fresh, hourly_rules),
        "reconciled": datestates.reconcile_states(own, fresh),
        "histogram": quantiles.value_histogram(fresh, alerts.LIMITED),
        "ids": datestates.id_bitmaps(fresh, {"grid_id": F.col("grid_id")}),
    }.items():
        write_zone(df, run.path(f"states/{name}"), STATES[f"states/{name}"], rebalance=True)


def build_rollups(spark: SparkSession, run: Run, hourly: DataFrame) -> None:
    for name, df in {
        "grid_performance": aggregate.grid_performance(hourly),
        "temporal_performance": aggregate.temporal_performance(hourly),
        "daily_kpi": aggregate.daily_kpi(hourly),
        "grid_kpi": aggregate.grid_kpi(hourly),
    }.items():
        _publish(spark, run, f"analytics/{name}", df)


def build_alerts(spark: SparkSession, run: Run, hourly: DataFrame) -> DataFrame:
    limits = alerts.thresholds(hourly, histogram=_state(spark, run, "histogram"))
    return _publish(spark, run, "analytics/alerts", alerts.alert_table(hourly, limits))


def read_fact(spark: SparkSession, run: Run) -> DataFrame:
    """The fact table under its time keys, which follow from the dates that are there."""
    dated = spark.read.parquet(run.path("warehouse/fact_network_activity"))
    return star.numbered_fact(dated, datestates.time_offsets(_state(spark, run, "hourly")))


def build_star(spark: SparkSession, run: Run, hourly: DataFrame, lookup: DataFrame, changed: Changed = Changed(None, None)):
    """Both dimensions anew, and the facts of the changed dates."""
    times = _publish(spark, run, "warehouse/dim_time", star.dim_time(hourly))
    grids = _publish(spark, run, "warehouse/dim_grid", star.dim_grid(hourly, lookup))
    if changed.dates != []:
        _publish(spark, run, "warehouse/fact_network_activity", star.dated_fact(changed.of(hourly)))
    return read_fact(spark, run), times, grids


def export_csv(spark: SparkSession, run: Run) -> None:
    """Header CSVs of the summaries, the hourly grid with day names, and alerts."""
    read = lambda n: spark.read.parquet(run.path(n))
    hourly = aggregate.with_day_names(read("processed/hourly_grid")).select(*HOURLY_COLUMNS).orderBy("timestamp", "grid_id")
    write_csv(read("analytics/daily_kpi").orderBy("date"), run.path("exports/daily_summary"))
    write_csv(read("analytics/grid_kpi").orderBy("grid_id"), run.path("exports/grid_summary"))
    write_csv(hourly, run.path("exports/grid_hour_activity"))
    write_csv(read("analytics/alerts").orderBy("timestamp", "alert_id"), run.path("exports/alerts"))


def delivery_totals(text: DataFrame) -> DataFrame:
    """One row of facts of delivered rows: distinct values, size, unusable timestamps."""
    raw = clean.coerce(clean.canonical_names(text)).withColumn("date", F.to_date("timestamp"))
    size = profile.table_size(text)
    invalid = checks.invalid_timestamps(text, parse_timestamp("datetime"))
    return aggregate.distinct_counts(
        raw, ["date", "grid_id", "country_code", "source_filename"], null_is_value=True
    ).select(
        "*", *[size.select(c).scalar().alias(c) for c in size.columns],
        invalid.select("invalid_timestamps").scalar().alias("invalid_timestamps"),
    )


def delivery_states(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts per delivered file, and the ids it holds as bitmaps: both add up over files."""
    raw = clean.coerce(clean.canonical_names(text)).withColumn("date", F.to_date("timestamp"))
    blank = F.trim(F.coalesce("datetime", F.lit(""))) == ""
    invalid = text.groupBy("source_filename").agg(
        F.count_if(~blank & parse_timestamp("datetime").isNull()).alias("invalid_timestamps"))
    nulls = raw.groupBy("source_filename").agg(*[
        F.max(F.col(c).isNull().cast("int")).alias(f"no_{c}") for c in ("date", "grid_id", "country_code")])
    facts = aggregate.file_summary(raw).join(invalid, "source_filename").join(nulls, "source_filename")
    ids = {"date": F.unix_date("date"), "grid_id": F.col("grid_id"), "country_code": F.col("country_code")}
    return facts, datestates.id_bitmaps(raw, ids, by="source_filename")


def totals_of(facts: DataFrame, ids: DataFrame, columns: int) -> DataFrame:
    """``delivery_totals`` from the states of all files."""
    names = ["date", "grid_id", "country_code"]
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    held = facts.agg(
        *[F.coalesce(F.max(f"no_{c}"), F.lit(0)).alias(f"no_{c}") for c in names],
        F.count_distinct("source_filename").alias("unique_source_filename"), total("rows").alias("row_count"),
        F.lit(columns).alias("column_count"), total("invalid_timestamps").alias("invalid_timestamps"))
    counts = datestates.bitmap_counts(ids, names)
    held = held.withColumns({f"unique_{c}": counts.select(f"unique_{c}").scalar() + F.col(f"no_{c}") for c in names})
    return held.drop(*[f"no_{c}" for c in names])


def delivery_summary(spark: SparkSession, run: Run, zones: Zones, text: DataFrame | None = None) -> DataFrame:
    """Facts of the accepted deliveries: totals row and one row per file.

    Only the files in ``text`` (all of the raw zone without it) are read; the rest is known from their states.
    """
    text = read_raw(spark, zones) if text is None else text
    for name, df in zip(("deliveries", "delivered_ids"), delivery_states(text)):
        write_zone(df, run.path(f"states/{name}"), STATES[f"states/{name}"], rebalance=True)
    facts = _state(spark, run, "deliveries")
    write_zone(totals_of(facts, _state(spark, run, "delivered_ids"), len(text.columns)), run.path("logs/delivery_totals"), "results")
    per_file = facts.drop("invalid_timestamps", "no_date", "no_grid_id", "no_country_code")
    write_zone(per_file, run.path("logs/delivery_files"), "results")
    return per_file


def validate_landing(spark: SparkSession, landing: str, out: str) -> DataFrame:
    """Verdicts of all landing files without routing them, kept as JSON rows."""
    found = gate.batch_verdicts(read_records(spark, landing), list_files(spark, landing))
    write_zone(found.select("file_path", "valid", "row_count", "reason"), out, "results")
    return spark.read.schema("file_path string, valid boolean, row_count bigint, reason string").json(out)


def table_rules(expected: Expected = Expected(), detail_rows: int | None = None, clean_rows: int | None = None,
                hourly_rows: int | None = None) -> tuple[Rules, Rules]:
    """The rules of the detail and the hourly table; sizes that are None are not checked."""
    bound = expected.timestamps and expected.cells and expected.timestamps * expected.cells
    return Rules(
        grain=CLEAN_GRAIN, required=CLEAN_COLUMNS, not_null=[c for c in CLEAN_COLUMNS if c != "country_code"],
        non_negative=[*MEASURES, *TOTALS], rows=detail_rows, all_hours=True,
    ), Rules(
        grain=HOURLY_GRAIN, required=HOURLY_COLUMNS, forbidden=["country_code"], not_null=HOURLY_COLUMNS,
        non_negative=[*MEASURES, *TOTALS], rows=hourly_rows,
        max_rows=bound, fewer_rows_than=None if clean_rows is None else clean_rows + 1, all_hours=True,
        distinct={"timestamp": expected.timestamps} if expected.timestamps else {},
        distinct_dates=expected.dates,
        # states keep the range of ids whether or not it is checked
        id_range=("grid_id", expected.cells) if expected.cells or hourly_rows is None else None)


def quality(spark: SparkSession, run: Run, detail: DataFrame, hourly: DataFrame, activity: DataFrame, lookup: DataFrame,
            star_tables: tuple[DataFrame, DataFrame, DataFrame], expected: Expected,
            features: DataFrame | None = None) -> DataFrame:
    """The check table of one run. Facts of the detail rows come from the states of all dates, not from the rows.

    ``features`` are those of the reference as delivered, unusable ones included.
    """
    files, state = _state(spark, run, "files"), lambda n: _state(spark, run, n)
    delivered = files.agg(F.coalesce(F.sum("clean_rows"), F.lit(0)).alias("n"), F.count_distinct("source_filename").alias("files")).first()
    detail_rules, hourly_rules = table_rules(
        expected, delivered.n, delivered.n, run.metrics["processed/hourly_grid"]["rows"])
    cells = datestates.bitmap_counts(state("ids"), ["grid_id"])
    stamps = state("detail").agg(F.coalesce(F.sum("stamps"), F.lit(0)).alias("stamps"))
    settled = state("reconciled").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias("off") for c in ["mismatched_keys"]])
    if features is None:
        features = lookup.select(
            F.lit("FeatureCollection").alias("document_type"), F.col("grid_id").cast("string").alias("cell_id"), "geometry")
    broken = star.constraint_summary(*star_tables).agg(F.sum("violations").alias("violations"))
    parts = [
        datestates.state_checks(state("detail"), "clean", detail_rules, detail.columns),
        datestates.state_checks(state("hourly"), "hourly grid", hourly_rules, hourly.columns, cells),
        checks.reference_checks(features, "reference", expected.cells),
        checks.value_check(stamps, "clean", "timestamp cadence", "stamps", delivered.files * 24),
        checks.gap_check(ordering.timestamp_gaps(hourly)),
        checks.value_check(enrich.coverage(hourly, lookup), "enriched", "coverage percent", "coverage_pct", 100.0),
        checks.preserved_check(hourly, activity, "enriched", "join keeps rows"),
        checks.value_check(
            compare.key_sets(hourly.select("grid_id"), lookup.select("grid_id"), ["grid_id"]),
            "enriched", "cells beyond the reference", "only_left", 0),
        checks.value_check(settled, "hourly grid", "keys that do not reconcile", "off", 0),
        checks.value_check(broken, "warehouse", "broken constraints", "violations", 0),
    ]
    if expected.files is not None:
        held = files.where("clean_rows > 0").agg(F.count_distinct("source_filename").alias("files"))
        parts.append(checks.value_check(held, "raw", "source files", "files", expected.files))
    return checks.collect_checks(*parts)


@scoped
def run_day(spark: SparkSession, landing: str, root: str, lookup: DataFrame | str, run_id: str,
            expected: Expected = Expected(), strict: bool = False, rebuild: bool = False) -> Run:
    """Gate, clean, aggregate, enrich, roll up, alert, load, check and record.

    A run judges the files that are new in the landing zone, reads only these
    from the raw zone and replaces only the dates they hold, in the tables and
    in the states per date that checks, alert limits and time keys are made of;
    rollups, alerts and dimensions follow from the hourly table. ``rebuild``
    judges all of landing again and makes every table anew. ``lookup`` is the
    path of the delivered reference, whose features are then checked as they
    came, or a table of cells. Totals of the deliveries are recorded too.
    """
    run, zones = Run(root), Zones(root)
    features = None
    if isinstance(lookup, str):
        features = cut(read_features(spark, lookup))
        lookup = cut(cell_lookup(features).dropDuplicates(["grid_id"]))
    require_cells(lookup)
    tasks = {}
    if rebuild:
        ingest(spark, landing, zones, owner=run_id)
    else:
        ingest_new(spark, landing, zones, run.path("logs/arrivals"))
    tasks["ingest"] = "SUCCESS"
    known = _stored(spark, run.path("states/files"))
    files = None if rebuild or known is None else new_files(spark, run, zones)
    changed = Changed([], [])
    if files == []:
        run.metrics = {"processed/detail": dict.fromkeys(["rows", "rejected_rows", "clean_rows", "nulls_handled"], 0)}
        read = lambda n: spark.read.parquet(run.path(n))
        detail, hourly = read("processed/detail").where(F.col("row_status") == "clean"), read("processed/hourly_grid")
        activity = read("processed/activity").select(*ACTIVITY_COLUMNS)
        run.metrics |= {n: {"rows": hourly.count()} for n in ("processed/hourly_grid", "processed/activity")}
    else:
        text = read_raw(spark, zones) if files is None else read_raw(spark, zones, files)
        delivery_summary(spark, run, zones, text)
        detail = build_detail(spark, run, text)
        changed, taken_in = changed_by(spark, run, files)
        hourly, activity = build_activity(spark, run, detail, lookup, changed)
        build_states(spark, run, detail, hourly, changed)
        build_rollups(spark, run, hourly)
        build_alerts(spark, run, hourly)
    tasks["spark_process"] = "SUCCESS"
    fact, times, grids = build_star(spark, run, hourly, lookup, changed)
    if files != []:
        write_zone(taken_in, run.path("states/files"), STATES["states/files"])
    tasks["load_warehouse"] = "SUCCESS"

    verify(spark, run.path("processed/activity"), run.metrics["processed/hourly_grid"]["rows"])
    verdicts = quality(spark, run, detail, hourly, activity, lookup, (fact, times, grids), expected, features)
    write_zone(verdicts, run.path("logs/quality"), "analytics")
    stored = read_table(spark, run.path("logs/quality"))
    failed = stored.where(~F.col("passed")).limit(1).count()
    tasks["quality_check"] = "FAILED" if failed else "SUCCESS"

    m = run.metrics["processed/detail"]
    record = reports.run_status(
        reports.table_status(fact, times, grids, read_ledger(spark, zones.ledger)),
        {"input_rows": m["rows"], "rejected_rows": m["rejected_rows"], "nulls_handled": m["nulls_handled"]},
        run_id, tasks)
    write_zone(record, run.path("logs/status"), "status")
    if strict:
        checks.enforce(stored)
    return run


def published(spark: SparkSession, run: Run) -> DataFrame:
    """One row per published table: is it there, with rows."""
    return present(spark, {n: run.path(n) for n in TABLES})
