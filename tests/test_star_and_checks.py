from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import checks, compare, layout, reports, star
from gridpulse.operators.aggregate import hourly_grid
from gridpulse.operators.checks import CheckFailed, Rules, collect_checks, enforce, table_checks
from gridpulse.operators.ordering import timestamp_gaps
from gridpulse.schemas import HOURLY_COLUMNS, HOURLY_GRAIN, MEASURES, TOTALS
from tests.test_aggregate import CLEAN, T0, make_clean


@pytest.fixture(scope="module")
def detail(spark):
    rows = [(T0 + timedelta(hours=h), c, cc, *[1.0 * c] * 5) for h in range(48) for c in (1, 2, 3) for cc in (39, 7)]
    return spark.createDataFrame(rows, CLEAN).cache()


@pytest.fixture(scope="module")
def hourly(detail):
    return hourly_grid(detail).cache()


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "grid_id long, geometry string")


@pytest.fixture(scope="module")
def tables(hourly, cells):
    times, grids = star.dim_time(hourly), star.dim_grid(hourly, cells)
    return star.fact_activity(hourly, times), times, grids


def test_dimensions(tables):
    fact, times, grids = tables
    rows = times.orderBy("time_id").collect()
    assert [r.time_id for r in rows] == list(range(1, 49))
    assert [r.timestamp for r in rows] == [T0 + timedelta(hours=h) for h in range(48)]
    assert {(r.grid_id, r.geometry) for r in grids.collect()} == {(1, "a"), (2, "b"), (3, "c")}
    assert fact.count() == 144


def test_dim_grid_from_rows_with_geometry(hourly, cells):
    wide = hourly.join(cells, "grid_id", "left")
    assert star.dim_grid(wide).exceptAll(star.dim_grid(hourly, cells)).count() == 0


@pytest.mark.parametrize("limit", [None, 0, 10**9])
def test_fact_is_the_same_with_every_join(hourly, tables, limit):
    fact, times, _ = tables
    assert star.fact_activity(hourly, times, limit).exceptAll(fact).count() == 0


def test_orphans_and_constraints(tables):
    fact, times, grids = tables
    clean = {r.constraint_name: r.violations for r in star.constraint_summary(fact, times, grids).collect()}
    assert len(clean) == 7 and set(clean.values()) == {0}
    broken = fact.unionByName(fact.where("time_id = 1 AND grid_id = 1")).withColumn(
        "sms_in", F.when(F.col("time_id") == 2, None).otherwise(F.col("sms_in")))
    bad = {r.constraint_name: r.violations for r in star.constraint_summary(
        broken, times.where("time_id <> 3"), grids.where("grid_id <> 2")).collect()}
    assert bad["fact primary key"] == 1 and bad["fact measures not null"] == 3
    assert bad["fact time foreign key"] == 3 and bad["fact grid foreign key"] == 48
    twice = {r.constraint_name: r.violations for r in star.constraint_summary(
        fact, times.unionByName(times.limit(1)), grids.unionByName(grids.limit(1))).collect()}
    assert (twice["dim_time primary key"], twice["dim_time unique timestamp"], twice["dim_grid primary key"]) == (1, 1, 1)


def test_reports(spark, tables):
    fact, times, grids = tables
    top = reports.leading_cells(fact, "total_activity", "total_activity").collect()
    assert [(r.grid_id, r.total_activity) for r in top] == [(3, 48 * 30.0), (2, 48 * 20.0), (1, 48 * 10.0)]
    trend = reports.by_hour(fact, times).collect()
    assert [r.hour for r in trend] == list(range(24)) and {r.total_activity for r in trend} == {120.0}
    windows = reports.leading_windows(fact, times).collect()
    assert len(windows) == 10 and windows[0].timestamp == T0 and windows[0].grid_id == 3
    assert reports.leading_cells(fact, "internet_activity", "total_internet_activity").first().total_internet_activity == 48 * 6.0
    assert reports.joined_rows(fact, times, grids).first()[0] == 144
    assert reports.joined_rows(fact, times, grids.where("grid_id > 1")).first()[0] == 96


def test_run_status_follows_checks_and_orphans(spark, tables):
    fact, times, grids = tables
    ledger = spark.createDataFrame(
        [("a", "ACCEPTED"), ("b", "REJECTED"), ("b", "REJECTED_DUPLICATE"), ("a", "SKIPPED_DUPLICATE")],
        "filename string, status string")
    counts = {"input_rows": 300, "rejected_rows": 12, "nulls_handled": 5}

    def status(g, tasks):
        return reports.run_status(reports.table_status(fact, times, g, ledger), counts, "r", tasks).first()

    good = status(grids, {"load": "SUCCESS"})
    assert (good.status, good.files_rejected, good.rows_in, good.rows_rejected, good.nulls_handled) == (
        "SUCCESS", 2, 300, 12, 5)
    assert (good.rows_published, good.dim_time_rows, good.dim_grid_rows, good.as_of) == (
        144, 48, 3, T0 + timedelta(hours=47))
    assert status(grids, {"load": "SUCCESS", "quality_check": "FAILED"}).status == "FAILED"
    lost = status(grids.where("grid_id <> 1"), {"load": "SUCCESS"})
    assert (lost.status, lost.orphan_grid_keys) == ("FAILED", 48)


RULES = dict(
    grain=HOURLY_GRAIN, required=HOURLY_COLUMNS, exact=HOURLY_COLUMNS, forbidden=["country_code"],
    not_null=HOURLY_COLUMNS, non_negative=[*MEASURES, *TOTALS], finite=MEASURES, rows=144, max_rows=144,
    fewer_rows_than=288, distinct={"timestamp": 48}, all_hours=True, distinct_dates=2, id_range=("grid_id", 3),
)


def failed(df, **changes):
    return {r.check_name for r in table_checks(df, "h", Rules(**{**RULES, **changes})).where("not passed").collect()}


def test_sound_table_passes_and_enforce_is_silent(hourly):
    result = table_checks(hourly, "h", Rules(**RULES))
    assert failed(hourly) == set() and result.columns == checks.CHECK_COLUMNS
    enforce(result)


def _set(df, column, value, where):
    return df.withColumn(column, F.when(F.expr(where), value).otherwise(F.col(column)))


BREAK = {
    "nulls in sms_in": lambda d: _set(d, "sms_in", F.lit(None), "grid_id = 1 AND hour = 0"),
    "negatives in call_out": lambda d: _set(d, "call_out", F.lit(-0.1), "grid_id = 1 AND hour = 0"),
    "not finite in internet_activity": lambda d: _set(d, "internet_activity", F.lit(float("nan")), "grid_id = 2"),
    "keys more than once": lambda d: d.unionByName(d.limit(1)),
    "rows beyond first per key": lambda d: d.unionByName(d.limit(1)),
    "exact row count": lambda d: d.where("NOT (grid_id = 1 AND hour = 3)"),
    "row bound": lambda d: d.unionByName(d.limit(1)),
    "distinct timestamp": lambda d: d.where("timestamp > '2013-11-01 00:00:00'"),
    "hours of day seen": lambda d: d.where("hour <> 7"),
    "distinct dates": lambda d: d.where("date = '2013-11-01'"),
    "largest id": lambda d: d.where("grid_id < 3"),
    "smallest id": lambda d: d.where("grid_id > 1"),
    "distinct ids": lambda d: d.where("grid_id <> 2"),
    "not empty": lambda d: d.limit(0),
    "exact ordered columns": lambda d: d.select(*reversed(d.columns)),
    "forbidden columns present": lambda d: d.withColumn("country_code", F.lit(1)),
}


@pytest.mark.parametrize("name", list(BREAK))
def test_each_check_can_fail(hourly, name):
    assert name in failed(BREAK[name](hourly))


def test_missing_column_and_too_many_rows(hourly):
    assert "required columns missing" in failed(
        hourly, required=[*HOURLY_COLUMNS, "geometry"])
    assert "fewer rows than input" in failed(hourly, fewer_rows_than=144)


def test_enforce_names_failures(hourly):
    with pytest.raises(CheckFailed, match="h: exact row count"):
        enforce(table_checks(hourly, "h", Rules(**{**RULES, "rows": 1})))


def test_reference_checks(spark):
    ok = [("FeatureCollection", "1", "g"), ("FeatureCollection", "2", "g")]
    bad = [("Feature", "1", "g"), ("FeatureCollection", "1", None), ("FeatureCollection", None, "g"),
           ("FeatureCollection", "x", "g")]
    schema = "document_type string, cell_id string, geometry string"
    run = lambda rows: {r.check_name: r for r in checks.reference_checks(
        spark.createDataFrame(rows, schema), "ref", 2).collect()}
    assert all(r.passed for r in run(ok).values())
    got = {n: r.observed for n, r in run(bad).items() if not r.passed}
    assert got == {"features outside a collection": 1, "missing ids": 1, "ids not integer": 1,
                   "ids more than once": 1, "missing geometry": 1, "distinct ids": 1}


def test_single_checks(spark, detail, hourly):
    files = detail.withColumn("source_filename", F.to_date("timestamp").cast("string"))
    one = lambda df: df.first().passed
    assert one(checks.cadence_check(files)) and not one(checks.cadence_check(files, hours_per_file=23))
    assert one(checks.file_count_check(files, 2)) and not one(checks.file_count_check(files, 3))
    assert one(checks.gap_check(timestamp_gaps(hourly)))
    assert not one(checks.gap_check(timestamp_gaps(hourly.where("hour <> 5"))))
    assert one(checks.preserved_check(hourly, layout.by_key(hourly, "grid_id", 3), "h", "n"))
    assert not one(checks.preserved_check(hourly, hourly.limit(3), "h", "n"))
    assert collect_checks(checks.gap_check(timestamp_gaps(hourly))).columns == checks.CHECK_COLUMNS


def test_reconcile_finds_every_kind_of_difference(spark, detail, hourly):
    assert compare.reconcile(detail, hourly).first().asDict() == {
        "keys": 144, "missing_in_hourly": 0, "missing_in_detail": 0, "stored_more_than_once": 0, "mismatched_keys": 0}
    bad = _set(hourly.where("NOT (grid_id = 1 AND hour = 0)"), "sms_in", F.lit(0.0), "grid_id = 2 AND hour = 1")
    extra = hourly.limit(1).withColumn("grid_id", F.lit(77).cast("long"))
    got = compare.reconcile(detail, bad.unionByName(extra).unionByName(
        hourly.where("grid_id = 3 AND timestamp = '2013-11-01 00:00:00'"))).first()
    assert (got.missing_in_hourly, got.missing_in_detail, got.stored_more_than_once) == (2, 1, 1)
    assert got.mismatched_keys == 3
    key = compare.first_key(hourly).first()
    assert (key["timestamp"], key["grid_id"]) == (T0, 1)
    hand = compare.reconcile_key(detail, hourly, T0, 2).collect()
    assert len(hand) == 5 and all(r.recomputed == r.stored == 4.0 for r in hand)


def test_key_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    got = compare.key_sets(a, b, ["k"]).first()
    assert (got.left_rows, got.right_rows, got.left_keys, got.right_keys, got.only_left, got.only_right,
            got.keys_equal) == (4, 3, 3, 3, 1, 1, False)
    assert compare.key_sets(a, a.distinct(), ["k"]).first().keys_equal


def test_layout(spark, hourly):
    keyed = layout.by_key(hourly, "grid_id", 4)
    rows = layout.partition_rows(keyed).collect()
    assert sum(r.rows for r in rows) == 144 and len(rows) <= 3
    assert layout.fewer(keyed, 4).rdd.getNumPartitions() == 2
    assert layout.partition_summary(layout.balanced(hourly, "date")).first().row_count == 144


def test_random_detail_reconciles(spark):
    _, df = make_clean(spark, hot=True)
    assert compare.reconcile(df, hourly_grid(df)).first().mismatched_keys == 0
