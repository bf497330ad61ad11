"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one applies library operators to whole tables. Frames that several jobs
of one query need are written once with ``cut``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.functions.columns import parse_timestamp, rounded
from gridpulse.functions.rowrules import header_failure, split_line
from gridpulse.operators import (
    aggregate, alerts, checks, clean, compare, enrich, gate, layout, ordering, profile, quantiles,
    reports, star,
)
from gridpulse.operators.checks import Rules
from gridpulse.plans import fixture
from gridpulse.schemas import (
    CLEAN_COLUMNS, CLEAN_GRAIN, HOURLY_COLUMNS, HOURLY_GRAIN, MEASURES, RAW_COLUMNS, RAW_GRAIN, TOTALS,
)
from gridpulse.sources.scratch import cut

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Calendar of the events table: January 1 to 30, 2024, hourly.
DAYS, HOURS = 30, 720
# Bounding box around the cells (min lon, max lon, min lat, max lat).
CELL_BOX = (8.8, 9.6, 45.2, 45.8)
# A dimension loaded after the first day knows only what that day held.
FIRST_LOAD_BEFORE = "2024-01-02 00:00:00"
# The cell that an incomplete lookup lacks.
MISSING_CELL = 7
# Deliveries dated up to this day count as received by an earlier run.
EARLIER_DELIVERY = "sms-call-internet-mi-2024-01-10.csv"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _round(df: DataFrame, *columns: str, decimals: int = 4) -> DataFrame:
    return df.withColumns({c: rounded(c, decimals) for c in columns})


def _typed(spark, sf_dir) -> DataFrame:
    """Delivered rows under canonical names and types, nothing rejected yet."""
    return clean.coerce(clean.canonical_names(fixture.raw_activity(spark, sf_dir)))


def _verdicts(raw: DataFrame, passed: str = gate.PASSED) -> DataFrame:
    return gate.table_verdicts(fixture.as_text(raw), "source_filename", ["h", "g", "cc"], passed)


def _routed(raw: DataFrame) -> DataFrame:
    """Routing when files up to a day had been delivered by an earlier run."""
    verdict = cut(_verdicts(raw))
    earlier = verdict.where(F.col("filename") <= EARLIER_DELIVERY)
    return gate.route(verdict, earlier.where("valid"), earlier.where(~F.col("valid")))


def _ledger(raw: DataFrame) -> DataFrame:
    return gate.ledger_entries(_routed(raw), "2024-02-01 00:00:00")


def _star(hourly: DataFrame, lookup: DataFrame):
    """Fact over a stored hourly table, and both dimensions, stored too."""
    times, grids = cut(star.dim_time(hourly)), cut(star.dim_grid(hourly, lookup))
    return star.fact_activity(hourly, times), times, grids


def _stored_star(spark, sf_dir):
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    return hourly, *_star(hourly, fixture.cell_lookup(spark, sf_dir))


def _fact_and_time(spark, sf_dir):
    """Without the cell dimension, for reports that do not use it."""
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    times = cut(star.dim_time(hourly))
    return star.fact_activity(hourly, times), times


# --------------------------------------------------------------------------
# cleaning
# --------------------------------------------------------------------------

@query
def clean_rows(spark, sf_dir):
    return fixture.clean_activity(spark, sf_dir)


@query
def rejected_rows(spark, sf_dir):
    raw = fixture.raw_activity(spark, sf_dir)
    typed = clean.coerce(clean.canonical_names(raw.withColumn("delivered", F.col("datetime"))))
    return clean.rejected(typed).select(
        "source_filename", "delivered", "grid_id", "country_code", "sms_in",
        F.array_join("reject_reasons", ",").alias("reasons"),
    )


@query
def reject_summary(spark, sf_dir):
    return clean.reject_summary(_typed(spark, sf_dir))


@query
def nulls_to_fill(spark, sf_dir):
    kept = clean.kept(_typed(spark, sf_dir))
    return profile.null_profile(kept, MEASURES)


@query
def row_reconciliation(spark, sf_dir):
    hourly_rows = fixture.hourly_activity(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    return clean.reject_summary(_typed(spark, sf_dir)).select(
        "input_rows", "rejected_rows", "clean_rows", hourly_rows.alias("hourly_rows"),
    ).select(
        "*",
        compare.row_conservation("input_rows", "rejected_rows", "clean_rows").alias("conserved"),
        (F.col("hourly_rows") < F.col("clean_rows")).alias("reduced"),
    )


# --------------------------------------------------------------------------
# profiling
# --------------------------------------------------------------------------

@query
def null_profile(spark, sf_dir):
    return profile.null_profile(fixture.raw_activity(spark, sf_dir), RAW_COLUMNS)


@query
def total_nulls(spark, sf_dir):
    return profile.null_totals(fixture.raw_activity(spark, sf_dir), RAW_COLUMNS)


@query
def measure_stats(spark, sf_dir):
    stats = profile.measure_stats(cut(_typed(spark, sf_dir).select(*MEASURES)))
    return _round(stats, "mean", "std", "median")


@query
def activity_totals(spark, sf_dir):
    return _round(profile.activity_totals_row(_typed(spark, sf_dir)), *TOTALS)


@query
def activity_ranges(spark, sf_dir):
    return _round(profile.activity_ranges(_typed(spark, sf_dir)), "min", "max", "mean")


@query
def duplicate_rows(spark, sf_dir):
    raw = cut(fixture.raw_activity(spark, sf_dir).select(*RAW_COLUMNS))
    whole = profile.duplicate_summary(raw.select(*RAW_COLUMNS)).withColumn("scope", F.lit("whole row"))
    grain = profile.duplicate_summary(raw, RAW_GRAIN).withColumn("scope", F.lit("raw grain"))
    return whole.unionByName(grain)


@query
def duplicate_groups(spark, sf_dir):
    return profile.duplicate_groups(fixture.raw_activity(spark, sf_dir), ["datetime", "CellID"])


@query
def distinct_counts(spark, sf_dir):
    df = _typed(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    return aggregate.distinct_counts(df, ["grid_id", "country_code", "timestamp", "date", "source_filename"])


@query
def distinct_counts_with_null(spark, sf_dir):
    return aggregate.distinct_counts(
        _typed(spark, sf_dir), ["grid_id", "country_code", "timestamp"], null_is_value=True)


@query
def id_time_ranges(spark, sf_dir):
    hourly = fixture.hourly_activity(spark, sf_dir)
    return aggregate.range_and_count(hourly, ["grid_id", "date", "hour"])


@query
def invalid_timestamps(spark, sf_dir):
    raw = fixture.raw_activity(spark, sf_dir)
    return checks.invalid_timestamps(raw, parse_timestamp("datetime"))


@query
def table_size(spark, sf_dir):
    hourly = fixture.hourly_activity(spark, sf_dir)
    return profile.table_size(hourly).select("row_count", "column_count")


@query
def first_rows(spark, sf_dir):
    hourly = fixture.hourly_activity(spark, sf_dir)
    return hourly.orderBy(*HOURLY_GRAIN).limit(10)


# --------------------------------------------------------------------------
# aggregation
# --------------------------------------------------------------------------

@query
def hourly_grid(spark, sf_dir):
    return fixture.hourly_activity(spark, sf_dir)


@query
def hourly_grid_named_days(spark, sf_dir):
    """Unrounded sums with English day names; rounded only for comparison."""
    hourly = aggregate.hourly_grid(fixture.clean_activity(spark, sf_dir), decimals=None)
    return _round(aggregate.with_day_names(hourly), *MEASURES, *TOTALS)


@query
def hourly_grid_geo(spark, sf_dir):
    """From rows that repeat the geometry; with the lookup at hand the text never meets a fact."""
    lookup = cut(fixture.cell_lookup(spark, sf_dir))
    activity = enrich.enrich(fixture.hourly_activity(spark, sf_dir), lookup)
    return aggregate.hourly_grid_geo(activity, lookup)


@query
def daily_kpi(spark, sf_dir):
    kpi = aggregate.daily_kpi(fixture.hourly_activity(spark, sf_dir))
    return _round(kpi, *aggregate.KPI_SUMS)


@query
def grid_kpi_share(spark, sf_dir):
    kpi = aggregate.grid_kpi(fixture.hourly_activity(spark, sf_dir))
    return _round(kpi, *aggregate.KPI_SUMS, "internet_share")


@query
def grid_performance(spark, sf_dir):
    perf = aggregate.grid_performance(fixture.hourly_activity(spark, sf_dir))
    return _round(perf, *[c for c in perf.columns if c != "grid_id"])


@query
def temporal_performance(spark, sf_dir):
    perf = aggregate.temporal_performance(fixture.hourly_activity(spark, sf_dir))
    return _round(perf, "timestamp_total_activity").orderBy("timestamp")


@query
def file_summary(spark, sf_dir):
    return aggregate.file_summary(_typed(spark, sf_dir)).orderBy("source_filename")


@query
def date_coverage(spark, sf_dir):
    return aggregate.date_coverage(_typed(spark, sf_dir))


@query
def hour_coverage(spark, sf_dir):
    return aggregate.hour_coverage(_typed(spark, sf_dir))


@query
def top_grids_geo(spark, sf_dir):
    return aggregate.top_grids_geo(
        fixture.hourly_activity(spark, sf_dir), fixture.cell_lookup(spark, sf_dir))


@query
def timestamp_gaps(spark, sf_dir):
    hourly = fixture.hourly_activity(spark, sf_dir)
    return ordering.timestamp_gaps(hourly).select("previous_timestamp", "timestamp", "diff_seconds")


@query
def busy_hour_gaps(spark, sf_dir):
    """Gaps between the hours in which some cell reached an activity of 100."""
    busy = fixture.hourly_activity(spark, sf_dir).where(F.col("total_activity") >= 100)
    return ordering.timestamp_gaps(busy).select("previous_timestamp", "timestamp", "diff_seconds")


# --------------------------------------------------------------------------
# windows and alerts
# --------------------------------------------------------------------------

@query
def previous_activity(spark, sf_dir):
    hourly = fixture.hourly_activity(spark, sf_dir)
    return alerts.with_previous(hourly).select(
        "timestamp", "grid_id", "total_activity", "previous_activity")


@query
def alert_thresholds(spark, sf_dir):
    hourly = cut(fixture.hourly_activity(spark, sf_dir).select("total_activity", "internet_activity"))
    t = alerts.thresholds(hourly)
    df = spark.createDataFrame(
        [(t.high_activity, t.high_internet, t.low_activity)],
        "high_activity double, high_internet double, low_activity double")
    return _round(df, *df.columns)


def _alert_input(spark, sf_dir):
    hourly = fixture.hourly_activity(spark, sf_dir)
    stored = cut(hourly.select("timestamp", "grid_id", "total_activity", "internet_activity"))
    return stored, alerts.thresholds(stored)


@query
def alert_table(spark, sf_dir):
    return _round(alerts.alert_table(*_alert_input(spark, sf_dir)), "value", "threshold")


@query
def alert_table_renumbered(spark, sf_dir):
    table = alerts.alert_table(*_alert_input(spark, sf_dir), renumber=True)
    return _round(table, "value", "threshold")


@query
def alert_counts(spark, sf_dir):
    hits = alerts.fired(*_alert_input(spark, sf_dir))
    both = hits.groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("n"))
    return both.orderBy(F.col("n").desc(), "alert_type")


@query
def alerts_by_severity(spark, sf_dir):
    return profile.value_counts(alerts.fired(*_alert_input(spark, sf_dir)), "severity")


# --------------------------------------------------------------------------
# star schema and reports
# --------------------------------------------------------------------------

@query
def dim_time(spark, sf_dir):
    return star.dim_time(fixture.hourly_activity(spark, sf_dir))


@query
def dim_grid(spark, sf_dir):
    return star.dim_grid(fixture.hourly_activity(spark, sf_dir), fixture.cell_lookup(spark, sf_dir))


@query
def fact_activity(spark, sf_dir):
    return _fact_and_time(spark, sf_dir)[0]


@query
def orphan_keys(spark, sf_dir):
    """Facts against dimensions that were loaded after the first day only."""
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    times = cut(star.dim_time(hourly))
    fact = star.fact_activity(hourly, times)
    early = hourly.where(F.col("timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    known_times = times.where(F.col("timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    stale = star.dim_grid(early, fixture.cell_lookup(spark, sf_dir))
    return star.orphan_summary(fact, known_times, stale)


@query
def star_constraints(spark, sf_dir):
    _, fact, times, grids = _stored_star(spark, sf_dir)
    return star.constraint_summary(fact, times, grids)


@query
def broken_constraints(spark, sf_dir):
    """The constraints of a warehouse in which each kind of damage occurs."""
    _, fact, times, grids = _stored_star(spark, sf_dir)
    cell = F.col("grid_id")
    bad_fact = cut(fact.unionByName(fact.where(cell == 3)).withColumn("sms_in", F.when(cell != 5, F.col("sms_in"))))
    early = times.where(F.col("timestamp") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    bad_grids = grids.where(cell != 6).unionByName(grids.where(cell == 4))
    return star.constraint_summary(bad_fact, early, bad_grids)


@query
def report_top_grids(spark, sf_dir):
    return reports.leading_cells(_fact_and_time(spark, sf_dir)[0], "total_activity", "total_activity")


@query
def report_hourly_trend(spark, sf_dir):
    fact, times = _fact_and_time(spark, sf_dir)
    return reports.by_hour(fact, times)


@query
def report_internet_windows(spark, sf_dir):
    fact, times = _fact_and_time(spark, sf_dir)
    return reports.leading_windows(fact, times)


@query
def report_top_internet(spark, sf_dir):
    return reports.leading_cells(_fact_and_time(spark, sf_dir)[0], "internet_activity", "total_internet_activity")


@query
def report_join_count(spark, sf_dir):
    _, fact, times, grids = _stored_star(spark, sf_dir)
    return reports.joined_rows(fact, times, grids)


@query
def run_status(spark, sf_dir):
    raw = cut(fixture.raw_activity(spark, sf_dir))
    typed = clean.coerce(clean.canonical_names(raw))
    hourly = cut(aggregate.hourly_grid(clean.finish(clean.kept(typed))))
    fact, times, grids = _star(hourly, fixture.cell_lookup(spark, sf_dir))
    counts = clean.reject_summary(typed).first()
    nulls = profile.null_totals(clean.kept(typed), MEASURES).first()[0]
    record = reports.run_status(
        reports.table_status(fact, times, grids, cut(_ledger(raw))),
        {"input_rows": counts.input_rows, "rejected_rows": counts.rejected_rows, "nulls_handled": nulls},
        run_id="fixture", tasks={"ingest": "SUCCESS", "process": "SUCCESS", "load": "SUCCESS"},
    )
    return record.drop("run_timestamp", "tasks")


# --------------------------------------------------------------------------
# gate
# --------------------------------------------------------------------------

@query
def file_verdicts(spark, sf_dir):
    return _verdicts(fixture.raw_activity(spark, sf_dir))


@query
def batch_verdicts(spark, sf_dir):
    return _verdicts(fixture.raw_activity(spark, sf_dir), gate.BATCH_PASSED)


@query
def file_routing(spark, sf_dir):
    return _routed(fixture.raw_activity(spark, sf_dir))


@query
def rows_by_route(spark, sf_dir):
    """Delivered rows per status: a file's rows go where the file goes."""
    raw = cut(fixture.raw_activity(spark, sf_dir))
    per_file = raw.groupBy(F.col("source_filename").alias("filename")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.join(_routed(raw), "filename").groupBy("status", "zone").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


@query
def ledger_entries(spark, sf_dir):
    return gate.latest_entries(_ledger(fixture.raw_activity(spark, sf_dir)))


@query
def rejected_file_count(spark, sf_dir):
    return reports.rejected_files(_ledger(fixture.raw_activity(spark, sf_dir)))


@query
def header_verdicts(spark, sf_dir):
    """Header rule on one header per file, spoiled by the file's day of month."""
    files = fixture.raw_activity(spark, sf_dir).select(
        "source_filename", F.dayofmonth("h").alias("day")).distinct()
    good = ",".join(RAW_COLUMNS)
    header = (
        F.when(F.col("day") <= 5, F.lit(good.replace(",internet", "")))
        .when(F.col("day") <= 10, F.lit(good + ",extra"))
        .when(F.col("day") <= 15, F.lit(good.replace("smsin,smsout", "smsout,smsin")))
        .when(F.col("day") <= 20, F.lit(good.replace("CellID", "cellid")))
        .otherwise(F.lit(good))
    )
    reason = header_failure(split_line(header))
    return files.select(
        "source_filename", reason.isNull().alias("valid"),
        F.coalesce(reason, F.lit("Schema valid")).alias("reason"),
    )


# --------------------------------------------------------------------------
# geometry
# --------------------------------------------------------------------------

def _lookup_without_one(spark, sf_dir) -> DataFrame:
    """Geometry of all cells but one: the case in which coverage fails."""
    return fixture.cell_lookup(spark, sf_dir, skip=F.col("grid_id") == MISSING_CELL)


@query
def grid_centroids(spark, sf_dir):
    return _round(enrich.centroids(fixture.cell_lookup(spark, sf_dir)), "longitude", "latitude", decimals=6)


@query
def odd_centroids(spark, sf_dir):
    """Centroids of MultiPolygons, triangles and cells without a geometry."""
    cells = fixture.cell_lookup(spark, sf_dir).withColumn("geometry", fixture.odd_geometry(F.col("grid_id")))
    return _round(enrich.centroids(cells), "longitude", "latitude", decimals=5)


@query
def enriched_activity(spark, sf_dir):
    """Left join to a lookup of all cells but one; rows are preserved."""
    return enrich.enrich(fixture.hourly_activity(spark, sf_dir), cut(_lookup_without_one(spark, sf_dir)))


@query
def enrichment_coverage(spark, sf_dir):
    """Full coverage, and coverage by a lookup that lacks one cell."""
    hourly = cut(fixture.hourly_activity(spark, sf_dir).select("grid_id"))
    full = enrich.coverage(hourly, fixture.cell_lookup(spark, sf_dir)).withColumn("lookup", F.lit("full"))
    return full.unionByName(enrich.coverage(hourly, _lookup_without_one(spark, sf_dir)).withColumn("lookup", F.lit("one missing")))


@query
def unmatched_cells(spark, sf_dir):
    return enrich.unmatched_cells(fixture.hourly_activity(spark, sf_dir), _lookup_without_one(spark, sf_dir))


@query
def geo_spot_check(spark, sf_dir):
    return enrich.spot_check(fixture.cell_lookup(spark, sf_dir), 1, 2, 15, CELL_BOX)


# --------------------------------------------------------------------------
# comparison and checks
# --------------------------------------------------------------------------

@query
def reconcile_all_keys(spark, sf_dir):
    detail = fixture.clean_activity(spark, sf_dir)
    return compare.reconcile(detail, aggregate.hourly_grid(detail))


@query
def reconcile_stale_hourly(spark, sf_dir):
    """An hourly table summed before the rows of country 0 had arrived."""
    detail = fixture.clean_activity(spark, sf_dir)
    stale = aggregate.hourly_grid(detail.where(F.col("country_code") > 0))
    return compare.reconcile(detail, stale)


@query
def reconcile_first_key(spark, sf_dir):
    """Hand check of the smallest key, re-summed from the detail rows."""
    detail = fixture.clean_activity(spark, sf_dir)
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    key = compare.first_key(hourly).first()
    return _round(compare.reconcile_key(detail, hourly, key["timestamp"], key["grid_id"]), "recomputed", "stored")


@query
def key_set_compare(spark, sf_dir):
    """Cells of the activity against cells of a lookup that lacks one."""
    return compare.key_sets(
        fixture.hourly_activity(spark, sf_dir).select("grid_id"),
        _lookup_without_one(spark, sf_dir).select("grid_id"), ["grid_id"])


@query
def quality_checks(spark, sf_dir):
    raw = clean.coerce(clean.canonical_names(cut(fixture.raw_activity(spark, sf_dir))))
    detail = cut(clean.finish(clean.kept(raw)))
    hourly = cut(aggregate.hourly_grid(detail))
    lookup = cut(fixture.cell_lookup(spark, sf_dir))
    cells = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("user_id") + 1).first()[0]
    detail_rows = detail.count()

    detail_rules = Rules(
        grain=CLEAN_GRAIN, required=CLEAN_COLUMNS, exact=CLEAN_COLUMNS,
        not_null=CLEAN_COLUMNS, non_negative=[*MEASURES, *TOTALS], all_hours=True)
    hourly_rules = Rules(
        grain=HOURLY_GRAIN, required=HOURLY_COLUMNS, exact=HOURLY_COLUMNS, forbidden=["country_code"],
        not_null=HOURLY_COLUMNS, non_negative=[*MEASURES, *TOTALS], max_rows=HOURS * cells,
        fewer_rows_than=detail_rows, distinct={"timestamp": HOURS}, all_hours=True,
        distinct_dates=DAYS, id_range=("grid_id", cells))
    features = lookup.select(
        F.lit("FeatureCollection").alias("document_type"),
        F.col("grid_id").cast("string").alias("cell_id"), "geometry")
    g = F.col("grid_id")
    damaged = lookup.select(
        F.when(g % 11 == 0, "Feature").otherwise("FeatureCollection").alias("document_type"),
        F.when(g % 13 == 1, None).when(g % 13 == 2, F.concat(F.lit("x"), g.cast("string")))
        .when(g % 13 == 3, (g + 1).cast("string")).otherwise(g.cast("string")).alias("cell_id"),
        F.when(g % 7 != 0, F.col("geometry")).alias("geometry"))
    covered = enrich.coverage(hourly, lookup)
    return checks.collect_checks(
        checks.table_checks(detail, "clean", detail_rules),
        checks.table_checks(hourly, "hourly grid", hourly_rules),
        checks.schema_checks(detail, "clean as hourly grid", hourly_rules),
        checks.schema_checks(hourly, "hourly grid as clean", detail_rules),
        checks.reference_checks(features, "reference", cells),
        checks.reference_checks(damaged, "damaged reference", cells),
        checks.cadence_check(clean.kept(raw)),
        checks.file_count_check(raw, DAYS),
        checks.gap_check(ordering.timestamp_gaps(hourly)),
        checks.value_check(covered, "enriched", "coverage percent", "coverage_pct", 100.0),
        checks.preserved_check(hourly, enrich.enrich(hourly, lookup), "enriched", "join keeps rows"),
        checks.flag_check(
            compare.key_sets(hourly.select("grid_id"), lookup.select("grid_id"), ["grid_id"]),
            "enriched", "same cells as reference", "keys_equal"),
        checks.value_check(
            compare.reconcile(detail, hourly), "hourly grid", "keys that do not reconcile", "mismatched_keys", 0),
        checks.preserved_check(hourly, layout.by_key(hourly, "grid_id"), "hourly grid", "layout keeps rows"),
    )


@query
def partition_rows(spark, sf_dir):
    """Rows of each cell after hashing on it, and in how many partitions they lie."""
    return layout.key_spread(layout.by_key(fixture.hourly_activity(spark, sf_dir), "grid_id", 8), "grid_id")


@query
def layout_keeps_rows(spark, sf_dir):
    """Row counts after each layout operator."""
    hourly = cut(fixture.hourly_activity(spark, sf_dir))
    variants = {
        "as stored": hourly,
        "by key": layout.by_key(hourly, "grid_id", 8),
        "rebalanced": layout.balanced(hourly, "date"),
        "fewer": layout.fewer(layout.by_key(hourly, "grid_id", 8), 8),
    }
    out = None
    for name, df in variants.items():
        one = layout.partition_summary(df).select(F.lit(name).alias("layout"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


# --------------------------------------------------------------------------
# the same operators on the largest table: shipments as activity
# --------------------------------------------------------------------------

def _shipments(spark, sf_dir) -> DataFrame:
    """lineitem as clean activity: ship date, supplier cell, four measures."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("l_suppkey").alias("grid_id"),
        F.col("l_quantity").cast("double").alias("sms_in"),
        F.col("l_extendedprice").cast("double").alias("sms_out"),
        F.col("l_discount").cast("double").alias("call_in"),
        F.col("l_tax").cast("double").alias("call_out"),
        F.lit(0.0).alias("internet_activity"),
    )


@query
def shipment_grid(spark, sf_dir):
    return aggregate.hourly_grid(_shipments(spark, sf_dir)).select(
        *HOURLY_GRAIN, *MEASURES, "total_activity")


@query
def shipment_daily_kpi(spark, sf_dir):
    kpi = aggregate.daily_kpi(aggregate.hourly_grid(_shipments(spark, sf_dir)))
    return _round(kpi, *aggregate.KPI_SUMS, decimals=2)


@query
def shipment_top_cells(spark, sf_dir):
    return aggregate.top_grids(aggregate.hourly_grid(_shipments(spark, sf_dir)), decimals=2)


@query
def shipment_quantiles(spark, sf_dir):
    df = _shipments(spark, sf_dir)
    wanted = {"sms_in": [0.05, 0.5, 0.95], "sms_out": [0.05, 0.5, 0.95]}
    found = quantiles.exact_quantiles(df, wanted)
    rows = spark.createDataFrame(
        [(m, p, v) for (m, p), v in found.items()], "metric string, p double, value double")
    return _round(rows, "value")


@query
def shipment_order_orphans(spark, sf_dir):
    """Shipments without an order, against all orders and those before 1995."""
    fact = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("order_id"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    known = orders.where(F.col("o_orderdate") < F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))
    whole = star.orphan_rows(fact, orders.select(F.col("o_orderkey").alias("order_id")), "order_id")
    early = star.orphan_rows(fact, known.select(F.col("o_orderkey").alias("order_id")), "order_id")
    return whole.withColumn("orders", F.lit("all")).unionByName(early.withColumn("orders", F.lit("before 1995")))


@query
def negative_balances(spark, sf_dir):
    """Reject operators on a table with naturally negative values: balances as a measure."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"), F.col("c_custkey").alias("grid_id"),
        F.col("c_nationkey").cast("bigint").alias("country_code"), F.col("c_acctbal").cast("double").alias("sms_in"),
        *[F.lit(0.0).alias(m) for m in MEASURES[1:]])
    return clean.reject_summary(customers)
