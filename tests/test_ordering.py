import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import alerts
from gridpulse.operators.ordering import ordinal, previous_value, timestamp_gaps

T0 = datetime(2024, 1, 1)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")


@pytest.mark.parametrize("hot", [False, True])
def test_previous_value_in_chunks_equals_one_window(spark, hot):
    rng = random.Random(3)
    rows = [(1 if hot and i % 3 else rng.randrange(4), T0 + timedelta(hours=h), rng.choice([None, 1.0, 2.0]))
            for i, h in enumerate(rng.sample(range(2000), 500))]
    df = _frame(spark, rows)
    plain = previous_value(df, ["k"], "ts", "v", "p")
    chunked = previous_value(df, ["k"], "ts", "v", "p", chunk=F.to_date("ts"))
    assert plain.exceptAll(chunked).count() == 0 and chunked.count() == 500
    want, last = {}, {}
    for k, t, v in sorted(rows, key=lambda r: (r[0], r[1])):
        want[k, t] = last.get(k)
        last[k] = v
    assert {(r.k, r.ts): r.p for r in chunked.collect()} == want


def test_previous_value_keeps_null_keys(spark):
    df = _frame(spark, [(None, T0, 1.0), (None, T0 + timedelta(days=2), 2.0)])
    got = previous_value(df, ["k"], "ts", "v", "p", chunk=F.to_date("ts")).orderBy("ts").collect()
    assert [r.p for r in got] == [None, 1.0]


def test_ordinal_equals_global_row_number(spark):
    rng = random.Random(5)
    rows = sorted({(rng.randrange(3), rng.randrange(-500, 500), rng.randrange(100)) for _ in range(2000)})
    df = spark.createDataFrame(rows, "rule int, cell int, t int").repartition(7)
    levels = [{"_r": F.col("rule"), "_b": F.floor(F.col("cell") / 64)}, {"_c": F.col("cell")}]
    got = {(r.rule, r.cell, r.t): r.n for r in ordinal(df, levels, ["t"], "n").collect()}
    assert got == {row: i + 1 for i, row in enumerate(rows)}


def test_ordinal_of_nothing(spark):
    df = spark.createDataFrame([], "rule int, t int")
    out = ordinal(df, [{"_r": F.col("rule")}], ["t"], "n")
    assert out.count() == 0 and out.columns == ["rule", "t", "n"]


def test_gaps_within_and_across_days(spark):
    hours = [0, 1, 3, 23, 24, 50, 51, 200]
    df = spark.createDataFrame([(T0 + timedelta(hours=h),) for h in hours + hours], "timestamp timestamp_ntz")
    got = [(r.previous_timestamp, r.timestamp, r.diff_seconds // 3600)
           for r in timestamp_gaps(df).orderBy("timestamp").collect()]
    want = [(T0 + timedelta(hours=a), T0 + timedelta(hours=b), b - a)
            for a, b in zip(hours, hours[1:]) if b - a != 1]
    assert got == want


def test_gaps_do_not_depend_on_the_session_zone(spark):
    """The night of a clock change in New York is an ordinary night here."""
    start = datetime(2024, 3, 9)
    df = spark.createDataFrame([(start + timedelta(hours=h),) for h in range(72)], "timestamp timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert timestamp_gaps(df).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ordinal_numbers_rows_with_null_levels(spark):
    rows = [(2, "b", 1), (None, "a", 3), (2, None, 5), (1, "a", 2), (None, None, 4), (2, None, 6)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    levels = [{"_k": F.col("k")}, {"_s": F.col("s")}]
    got = {r.v: r.n for r in ordinal(df, levels, ["v"], "n").collect()}
    want = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or ""), r[2]))
    assert got == {r[2]: i for i, r in enumerate(want, 1)}


def test_alerts_of_a_null_cell_are_kept(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", None, 9.0, 1.0), ("2024-01-01 00:00:00", 1, 8.0, 2.0)],
                               "timestamp string, grid_id bigint, total_activity double, internet_activity double")
    hourly = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    limits = alerts.thresholds(hourly)
    fired = alerts.fired(hourly, limits).count()
    table = alerts.alert_table(hourly, limits).collect()
    assert fired == len(table) and sorted(r.alert_id for r in table) == list(range(1, fired + 1))
