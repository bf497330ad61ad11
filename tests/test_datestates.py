"""States per date against the same facts taken from all rows at once."""

import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import aggregate, checks, datestates, layout, quantiles, star
from gridpulse.operators.checks import Rules
from gridpulse.plans import fixture
from gridpulse.sources import scratch, sinks, tables
from gridpulse.sources.scratch import cut, scope, scratch_path, scratch_root

RULES = Rules(
    grain=["timestamp", "grid_id"], required=["timestamp", "gone"], forbidden=["v"], not_null=["grid_id", "v"], non_negative=["v"],
    finite=["v"], rows=7, max_rows=5, fewer_rows_than=8, distinct={"timestamp": 4}, all_hours=True, distinct_dates=2, id_range=("grid_id", 9))
ROWS = [("2024-01-01 01:00:00", 1, 1.0), ("2024-01-01 01:00:00", 1, None), ("2024-01-01 02:00:00", 9, -1.0), ("2024-01-02 01:00:00", 9, float("nan")),
        ("2024-01-02 01:00:00", None, float("inf")), ("2024-01-02 23:00:00", 4, 0.0), ("2024-01-02 23:00:00", 4, 0.0)]


def table(spark, rows):
    df = spark.createDataFrame(rows, "t string, grid_id bigint, v double")
    return df.select(F.col("t").cast("timestamp_ntz").alias("timestamp"), F.to_date("t").alias("date"), "grid_id", "v")


@pytest.mark.parametrize("rows", [ROWS, []])
def test_checks_from_states_equal_those_from_rows(spark, rows):
    df = cut(table(spark, rows))
    ids = datestates.bitmap_counts(datestates.id_bitmaps(df, {"grid_id": F.col("grid_id")}), ["grid_id"])
    got = datestates.state_checks(datestates.rule_states(df, RULES), "t", RULES, df.columns, ids).collect()
    want = checks.table_checks(df, "t", RULES).collect()
    assert sorted(got) == sorted(want) and len(got) > 15


def test_other_distinct_values_cannot_be_told_from_dates(spark):
    rules = Rules(grain=["timestamp"], distinct={"grid_id": 3})
    with pytest.raises(ValueError):
        datestates.state_checks(datestates.rule_states(table(spark, ROWS), rules), "t", rules, [])


def test_key_print_ignores_order_and_repeats(spark):
    rules = Rules(grain=["timestamp", "grid_id"])
    prints = lambda rows: {r.date: r.key_print for r in datestates.rule_states(table(spark, rows), rules).collect()}
    assert prints(ROWS) == prints(ROWS[::-1] + ROWS[:1]) != prints([*ROWS, ("2024-01-02 05:00:00", 4, 0.0)])


def test_histogram_quantiles_equal_percentiles(spark, monkeypatch):
    random.seed(3)
    rows = [(f"2024-01-{d + 1:02d} 00:00:00", d, random.choice([random.gauss(0, 10.0 ** d), 0.0, float("nan"), None])) for d in range(6) for _ in range(400)]
    df, path = cut(table(spark, rows)), scratch_path(spark, "histogram")
    sinks.replace_partitions(quantiles.value_histogram(df, ["v"]), path)
    changed = cut(df.where("date <> '2024-01-03'").unionByName(df.where("date = '2024-01-03'").withColumn("v", F.col("v") + 0.5)))
    sinks.replace_partitions(quantiles.value_histogram(changed.where("date = '2024-01-03'"), ["v"]), path)
    seen, narrow = [], quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda rows, *a: seen.append(rows.count()) or narrow(rows, *a))
    for few in (1_000_000, 0):
        monkeypatch.setattr(quantiles, "VALUE_ROWS", few)
        got = quantiles.histogram_quantiles(spark.read.parquet(path), changed, {"v": [0.0, 0.05, 0.5, 0.999, 1.0]})
        plain = changed.where(~F.isnan("v"))
        for (_, p), value in got.items():
            assert value == pytest.approx(plain.agg(F.percentile("v", p)).first()[0], rel=1e-12), p
    two = cut(table(spark, [(f"2024-01-0{d} 00:00:00", 1, base + random.random() / 2) for d, base in ((1, 0.0), (2, 1000.0)) for _ in range(400)]))
    seen.clear()
    top = quantiles.histogram_quantiles(cut(quantiles.value_histogram(two, ["v"])), two, {"v": [0.9]})["v", 0.9]
    assert top == pytest.approx(two.agg(F.percentile("v", 0.9)).first()[0], rel=1e-12) and set(seen) == {400}  # one date reaches that far
    assert quantiles.histogram_quantiles(spark.read.parquet(path).where("n < 0"), changed, {"v": [0.5]}) == {("v", 0.5): None}


def test_bitmaps_count_any_ids(spark):
    df = spark.createDataFrame([(d, i) for d in (1, 2) for i in (-40_000, -1, 0, 1, 32_768, 32_769, 2**40, None, d)], "d int, i bigint")
    bits = datestates.id_bitmaps(df, {"i": F.col("i"), "none": F.lit(None)}, by="d")
    row = datestates.bitmap_counts(bits, ["i", "none"]).first()
    assert (row.unique_i, row.unique_none) == (8, 0)
    assert "Expand" not in bits._jdf.queryExecution().executedPlan().toString()


def test_late_date_rewrites_no_other_facts(spark, sf, tmp_path):
    hourly, path, states = cut(fixture.hourly_activity(spark, sf)), str(tmp_path / "fact"), str(tmp_path / "states")
    rules = Rules(grain=["timestamp", "grid_id"])
    late = F.col("date") == "2024-01-10"
    files = lambda: {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/*/*.parquet")}
    for n, part in enumerate((hourly.where(~late), hourly.where(late))):
        before = files()
        sinks.write_zone(star.dated_fact(part), path, "processed")
        sinks.write_zone(datestates.rule_states(part, rules), states, "processed")
        assert n == 0 or ({k: v for k, v in files().items() if "2024-01-10" not in k} == before and len(files()) > len(before))
    got = star.numbered_fact(spark.read.parquet(path), datestates.time_offsets(spark.read.parquet(states)))
    want = star.fact_activity(hourly, star.dim_time(hourly))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.dtypes == want.dtypes


def test_footers_answer_without_rows(spark, sf, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_zone(fixture.hourly_activity(spark, sf), path, "processed")
    plan = tables.footer_facts(spark, path, ["grid_id"], ("date",))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(grid_id), MAX(grid_id)]" in plan and "PushedGroupBy: [date]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_buckets_spare_the_shuffle(spark, sf, tmp_path):
    name = "bucketed_test"
    t = layout.bucketed(fixture.hourly_activity(spark, sf), name, str(tmp_path / name), "grid_id", 4)
    other = cut(aggregate.grid_kpi(t))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(aggregate.grid_performance(t))
    assert "Exchange hashpartitioning" in plan(aggregate.grid_performance(cut(t)))
    both = t.hint("merge").join(layout.bucketed(other, f"{name}2", str(tmp_path / "b"), "grid_id", 4), "grid_id")
    assert "Exchange" not in plan(both) and both.count() == t.count()


def test_scope_owns_its_tables(spark):
    there = lambda p: os.path.exists(p.removeprefix("file://"))
    outer = scratch_path(spark)
    with scope(spark):
        one = cut(spark.range(3))
        with pytest.raises(RuntimeError), scope(spark):
            inner = cut(spark.range(4)).inputFiles()[0]
            raise RuntimeError
        assert one.count() == 3 and not there(os.path.dirname(inner).replace("file:///", "/"))
        kept = os.path.dirname(one.inputFiles()[0]).replace("file:///", "/")
        assert there(kept)
    assert not there(kept) and outer in scratch._WRITTEN and scratch_root(spark) in outer


def test_second_of_is_the_distance_in_seconds(spark):
    t = datetime(2024, 2, 29, 13, 7, 59)
    df = spark.createDataFrame([(t,), (datetime(1970, 1, 1) - timedelta(seconds=1),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(datestates.second_of("t")).collect()]
    assert got == [int((t - datetime(1970, 1, 1)).total_seconds()), -1]
