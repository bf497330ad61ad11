from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridpulse.functions.columns import day_name, parse_timestamp, percent_of, rounded, safe_ratio
from gridpulse.operators import clean
from gridpulse.schemas import (
    CLEAN_COLUMNS, RAW_COLUMNS, require_absent, require_columns, require_exact_columns,
)

RAW = "datetime string, CellID string, countrycode string, smsin string, smsout string, callin string, callout string, internet string"


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([
        ("2013-11-01 00:00:00", "1", "39", "1.5", None, "0.25", "", "2"),
        ("2013-11-1 5:0:0", "2", None, None, None, None, None, None),
        ("2013-11-01", "3", "39", "1", "1", "1", "1", "1"),
        ("2013-11-01 01:00:00", "x", "39", "1", "1", "1", "1", "1"),
        ("nonsense", None, "39", "-1", "1", "1", "1", "1"),
        ("2013-11-01 02:00:00", "4", "39", "nan", "1", "1", "1", "1"),
        ("2013-11-01 02:00:00", "4", "39", "1", "1", "1", "1", "-0.01"),
    ], RAW)


def test_clean_values(raw):
    rows = clean.clean(raw).orderBy("grid_id").collect()
    assert [r.grid_id for r in rows] == [1, 2, 4]
    first = rows[0]
    assert list(first.asDict()) == CLEAN_COLUMNS
    assert (first.timestamp, first.date, first.hour, first.day_of_week) == (
        datetime(2013, 11, 1), date(2013, 11, 1), 0, 6)
    assert (first.sms_in, first.sms_out, first.call_in, first.call_out) == (1.5, 0.0, 0.25, 0.0)
    assert (first.total_sms, first.total_calls, first.total_activity) == (1.5, 0.25, 3.75)
    assert rows[1].country_code is None and rows[1].total_activity == 0.0
    assert rows[2].sms_in != rows[2].sms_in  # nan is neither negative nor null


def test_reject_reasons_overlap(raw):
    typed = clean.coerce(clean.canonical_names(raw))
    got = clean.reject_summary(typed).first().asDict()
    assert got == {"input_rows": 7, "missing_timestamp": 2, "missing_grid_id": 2,
                   "negative_activity": 2, "rejected_rows": 4, "clean_rows": 3}
    worst = clean.rejected(typed).where(F.size("reject_reasons") == 3).collect()
    assert len(worst) == 1 and worst[0].reject_reasons == clean.REJECT_REASONS


def test_one_pass_table_equals_clean_and_rejected(raw):
    typed = clean.coerce(clean.canonical_names(raw))
    table = clean.finish_all(typed)
    kept = table.where("row_status = 'clean'").select(*CLEAN_COLUMNS)
    assert kept.exceptAll(clean.clean(raw)).count() == 0 and kept.count() == 3
    bad = table.where("row_status = 'rejected'")
    assert bad.count() == 4 and bad.where("reject_reasons = ''").count() == 0


def test_rounding_once_or_per_row(spark):
    raw = spark.createDataFrame([("2013-11-01 00:00:00", "1", "39", "0.00004", "0", "0", "0", "0")], RAW)
    assert clean.clean(raw).first().sms_in == 0.0
    assert clean.clean(raw, round_rows=False).first().sms_in == 0.00004


def test_name_normaliser(spark):
    assert [clean.normal_name(n) for n in (" DateTime ", "Cell_ID", "CELLID", "Sms Out-2/x.y", "internet")] == [
        "timestamp", "grid_id", "grid_id", "sms_out_2_x_y", "internet_activity"]
    df = spark.createDataFrame([(1, 2)], "`CellID` int, `Call Type` int")
    assert clean.normalise_names(df).columns == ["grid_id", "call_type"]


@pytest.mark.parametrize("text,want", [
    ("2013-1-1 0:0:0", datetime(2013, 1, 1)),
    (" 2013-11-01 23:59:59 ", datetime(2013, 11, 1, 23, 59, 59)),
    ("2013-11-01T00:00:00", None), ("2013-11-01", None), ("2013-02-30 00:00:00", None),
    ("2013-11-01 24:00:00", None), ("2013-11-01 00:00:00Z", None), ("", None), (None, None),
])
def test_parse_timestamp(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_timestamp("t")).first()[0] == want


def test_wall_clock_does_not_move_with_the_session_zone(spark):
    df = spark.createDataFrame([("2013-03-10 02:30:00",)], "t string")  # skipped hour in New York
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(F.hour(parse_timestamp("t"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == 2


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0, datetime(2013, 11, 3))], "a double, b double, t timestamp_ntz")
    assert df.select(safe_ratio("a", "b"), safe_ratio("b", "a")).first() == (None, 0.0)
    assert df.select(percent_of(F.lit(1), F.lit(3))).first()[0] == 33.33
    assert df.select(day_name("t")).first()[0] == "Sunday"


def test_contracts(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    require_columns(df, ["b"])
    require_exact_columns(df, ["a", "b"])
    require_absent(df, ["country_code"])
    for bad in (lambda: require_columns(df, ["c"]), lambda: require_exact_columns(df, ["b", "a"]),
                lambda: require_absent(df, ["a"]), lambda: clean.coerce(df)):
        with pytest.raises(ValueError):
            bad()
    assert len(RAW_COLUMNS) == 8


def test_rounded_equals_round_in_every_bit(spark):
    edge = [5e-05, -5e-05, 0.00015, 2.67505, 1.00005, -1e-05, -0.0, float("nan"), float("inf"), -float("inf"),
            1e300, 123456789012.34565, 1e15 + 0.5, None, 5e-324, 0.12345, 0.99995, 99999999.99995]
    ties = spark.range(200000).select(((F.col("id") - 100000) / 20000.0).alias("x"))
    noisy = spark.range(200000).select(((F.rand(3) - 0.5) * F.pow(10.0, F.rand(4) * 12)).alias("x"))
    df = spark.createDataFrame([(x,) for x in edge], "x double").union(ties).union(noisy).cache()
    for decimals in (2, 4, 6):
        a, b = F.round("x", decimals), rounded("x", decimals)
        same = a.eqNullSafe(b) & (a.cast("string").eqNullSafe(b.cast("string")))
        assert df.where(~same).count() == 0
