import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import aggregate, profile
from gridpulse.schemas import FACT_MEASURES, HOURLY_COLUMNS, MEASURES

T0 = datetime(2013, 11, 1)
CLEAN = ("timestamp timestamp_ntz, grid_id long, country_code long, sms_in double, sms_out double, "
         "call_in double, call_out double, internet_activity double")


def make_clean(spark, n=600, seed=0, hot=False):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        cell = 1 if hot and rng.random() < 0.4 else rng.randrange(1, 6)
        rows.append((T0 + timedelta(hours=rng.randrange(30)), cell, rng.choice([None, 39, 7]),
                     *[round(rng.random() * 10, 4) for _ in MEASURES]))
    return rows, spark.createDataFrame(rows, CLEAN)


def test_hourly_grid_values(spark):
    _, df = make_clean(spark)
    rows = [
        (T0, 1, 39, 1.0, 2.0, 3.0, 4.0, 5.0), (T0, 1, None, 0.1, 0.2, 0.3, 0.4, 0.5), (T0, 2, 39, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    got = aggregate.hourly_grid(spark.createDataFrame(rows, CLEAN)).orderBy("grid_id").collect()
    assert list(got[0].asDict()) == HOURLY_COLUMNS
    assert (got[0].sms_in, got[0].total_sms, got[0].total_calls, got[0].total_activity) == (1.1, 3.3, 7.7, 16.5)
    assert (got[0].date, got[0].hour, got[0].day_of_week) == (date(2013, 11, 1), 0, 6)
    assert got[1].total_activity == 0.0


def test_grain_conservation_and_order_independence(spark):
    rows, df = make_clean(spark, hot=True)
    hourly = aggregate.hourly_grid(df)
    assert hourly.count() == len({(r[0], r[1]) for r in rows})
    for m, i in zip(MEASURES, range(3, 8)):
        assert hourly.agg(F.sum(m)).first()[0] == pytest.approx(sum(r[i] for r in rows), abs=1e-6)
    shuffled = aggregate.hourly_grid(df.orderBy(F.rand(1)))
    assert hourly.exceptAll(shuffled).count() == 0


def test_rollup_of_rollup_equals_direct(spark):
    _, df = make_clean(spark)
    via = aggregate.grid_performance(aggregate.hourly_grid(df)).orderBy("grid_id").collect()
    direct = df.groupBy("grid_id").agg(*[F.sum(m).alias(m) for m in MEASURES]).orderBy("grid_id").collect()
    for a, b in zip(via, direct):
        assert a.grid_id == b.grid_id
        for m in MEASURES:
            assert a[f"window_{m}"] == pytest.approx(b[m], abs=1e-3)


def test_kpis(spark):
    _, df = make_clean(spark)
    hourly = aggregate.hourly_grid(df)
    assert aggregate.daily_kpi(hourly).columns == ["date", *aggregate.KPI_SUMS]
    zero = spark.createDataFrame([(T0, 9, 39, 0.0, 0.0, 0.0, 0.0, 0.0)], CLEAN)
    shares = {r.grid_id: r.internet_share for r in aggregate.grid_kpi(aggregate.hourly_grid(df.union(zero))).collect()}
    assert shares[9] is None and 0 < shares[1] < 1


def test_hourly_grid_geo_picks_one_geometry(spark):
    rows = [(T0, 1, *[1.0] * 6, "b"), (T0, 1, *[2.0] * 6, None), (T0, 1, *[1.0] * 6, "a"), (T0, 2, *[1.0] * 6, None)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, grid_id long, " + ", ".join(
        f"{m} double" for m in FACT_MEASURES) + ", geometry string")
    got = aggregate.hourly_grid_geo(df).orderBy("grid_id").collect()
    assert [(r.grid_id, r.sms_in, r.geometry) for r in got] == [(1, 4.0, "a"), (2, 1.0, None)]


def test_top_grids_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 5.0), (4, 1.0)], "grid_id long, total_activity double")
    assert [r.grid_id for r in aggregate.top_grids(df, n=3).collect()] == [2, 1, 3]


def test_file_summary_and_coverage(spark):
    rows = [("a", 1, T0), ("a", 1, T0 + timedelta(hours=2)), ("a", None, None), ("b", 2, T0)]
    df = spark.createDataFrame(rows, "source_filename string, grid_id long, timestamp timestamp_ntz")
    got = {r.source_filename: r for r in aggregate.file_summary(df).collect()}
    assert (got["a"].rows, got["a"].unique_grids, got["a"].max_timestamp) == (3, 1, T0 + timedelta(hours=2))
    assert {(r.date, r.rows) for r in aggregate.date_coverage(df).collect()} == {(date(2013, 11, 1), 3)}
    cover = aggregate.hour_coverage(df).first()
    assert (cover.hour_count, cover.hours_seen, cover.complete) == (2, "0,2", False)
    assert cover.hours_missing.split(",")[0] == "1" and len(cover.hours_missing.split(",")) == 22
    nulls_out = aggregate.distinct_counts(df, ["grid_id"]).first()[0]
    nulls_in = aggregate.distinct_counts(df, ["grid_id"], null_is_value=True).first()[0]
    assert (nulls_out, nulls_in) == (2, 3)


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (3, "x")], "a int, b string")
    got = profile.duplicate_summary(df).first()
    assert (got.row_count, got.duplicate_rows, got.duplicate_groups) == (5, 2, 1)
    by_b = profile.duplicate_summary(df, ["b"]).first()
    assert (by_b.duplicate_rows, by_b.duplicate_groups) == (3, 2)
    assert profile.duplicate_summary(df.limit(0)).first().row_count == 0
    assert profile.duplicate_groups(df, ["a"]).collect()[0]["count"] == 3


def test_null_profile_and_stats(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, 3.0)], "x double, y double")
    got = {r.column_name: r for r in profile.null_profile(df).collect()}
    assert (got["y"].null_count, got["y"].non_null_count, got["y"].null_percentage) == (2, 1, 66.67)
    assert profile.null_totals(df).first()[0] == 2
    stats = {r.metric: r for r in profile.measure_stats(df, ["x", "y"]).collect()}
    assert (stats["x"]["count"], stats["x"]["median"], stats["x"]["max"]) == (3, 2.0, 4.0)
    assert stats["x"]["std"] == pytest.approx(1.5275252)
    assert stats["y"]["std"] is None and stats["y"]["median"] == 3.0


def test_table_size_and_value_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string").repartition(3)
    size = profile.table_size(df).first()
    assert (size.row_count, size.column_count) == (4, 1) and 1 <= size.partition_count <= 3
    assert [(r.k, r["count"]) for r in profile.value_counts(df, "k").collect()] == [("b", 2), ("a", 1), ("c", 1)]
