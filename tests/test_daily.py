import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import alerts, gate, star
from gridpulse.operators.aggregate import hourly_grid
from gridpulse.operators.checks import CheckFailed
from gridpulse.operators.clean import canonical_names, clean
from gridpulse.plans import daily, fixture
from gridpulse.plans.daily import Expected
from gridpulse.schemas import RAW_COLUMNS, TEMPORAL_PERFORMANCE_COLUMNS, GRID_PERFORMANCE_COLUMNS
from gridpulse.sources import sinks, tables
from gridpulse.sources.delimited import file_stem, read_deliveries
from gridpulse.sources.scratch import cut, scratch_root
from gridpulse.streaming.arrivals import Zones, read_raw


@pytest.fixture(scope="module")
def landing(spark, sf, tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    raw = fixture.raw_activity(spark, sf).orderBy("source_filename", "h", "g", "cc").toPandas()
    raw["CellID"] = raw["CellID"].astype("Int64")
    for name, rows in raw.groupby("source_filename"):
        rows[RAW_COLUMNS].to_csv(d / name, index=False)
    return d


@pytest.fixture(scope="module")
def run(spark, sf, landing, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return daily.run_day(spark, str(landing), root, fixture.cell_lookup(spark, sf), "run-1", Expected(files=25))


def test_deliveries_with_lineage(spark, landing):
    df = read_deliveries(spark, str(landing))
    assert df.columns == [*RAW_COLUMNS, "source_file", "source_filename"] and df.count() == 995
    assert df.select(F.count_distinct("source_filename")).first()[0] == 30
    stem = df.select(file_stem(F.col("source_file")) == F.col("source_filename")).distinct().collect()
    assert [r[0] for r in stem] == [True]


def test_chain_publishes_what_the_accepted_files_hold(spark, run):
    accepted = read_raw(spark, Zones(run.root))
    want = hourly_grid(clean(accepted))
    got = spark.read.parquet(run.path("processed/hourly_grid")).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    counted = run.metrics["processed/detail"]
    assert counted["rows"] == accepted.count() == counted["clean_rows"] + counted["rejected_rows"]
    nulls = canonical_names(accepted).select(sum(
        F.col(c).isNull().cast("int") for c in ("sms_in", "sms_out", "call_in", "call_out", "internet_activity")
    ).alias("n")).agg(F.sum("n")).first()[0]
    assert counted["nulls_handled"] == nulls
    assert all(r.present for r in daily.published(spark, run).collect())


def test_chain_alerts_and_star(spark, run):
    hourly = spark.read.parquet(run.path("processed/hourly_grid"))
    want = alerts.alert_table(hourly, alerts.thresholds(hourly))
    assert want.exceptAll(spark.read.parquet(run.path("analytics/alerts"))).count() == 0
    fact, times = daily.read_fact(spark, run), spark.read.parquet(run.path("warehouse/dim_time"))
    want = star.fact_activity(hourly, times)
    assert fact.columns == want.columns and fact.exceptAll(want).count() == want.exceptAll(fact).count() == 0
    assert fact.count() == hourly.count() == run.metrics["processed/activity"]["rows"]


def test_status_record_is_one_document(spark, run):
    docs = spark.read.text(run.path("logs/status")).collect()
    record = json.loads(docs[0][0])
    assert len(docs) == 1 and record["run_id"] == "run-1" and record["files_rejected"] == 5
    assert record["status"] == "FAILED" and record["tasks"]["quality_check"] == "FAILED"  # hours are missing
    assert record["fact_rows"] == record["rows_published"] and record["orphan_time_keys"] == 0


def test_strict_run_raises(spark, sf, landing, tmp_path):
    with pytest.raises(CheckFailed, match="gaps between timestamps"):
        daily.run_day(spark, str(landing), str(tmp_path / "l"), fixture.cell_lookup(spark, sf), "r", strict=True)


def test_rerun_changes_nothing(spark, sf, landing, tmp_path):
    root, cells = str(tmp_path / "lake"), fixture.cell_lookup(spark, sf)
    first = daily.run_day(spark, str(landing), root, cells, "a", rebuild=True)
    second = daily.run_day(spark, str(landing), root, cells, "b", rebuild=True)
    assert first.metrics == second.metrics
    statuses = {r.status: r["count"] for r in sinks.read_ledger(spark, Zones(root).ledger).groupBy("status").count().collect()}
    assert statuses == {"ACCEPTED": 25, "REJECTED": 5, "SKIPPED_DUPLICATE": 25, "REJECTED_DUPLICATE": 5}


def test_a_new_day_reads_only_its_file(spark, sf, landing, tmp_path, monkeypatch):
    import shutil

    root, cells, early = str(tmp_path / "lake"), fixture.cell_lookup(spark, sf), tmp_path / "landing"
    early.mkdir()
    names = sorted(p.name for p in landing.glob("*.csv"))
    late = "sms-call-internet-mi-2024-01-09.csv"
    for n in names:
        if n != late:
            shutil.copy(landing / n, early / n)
    first = daily.run_day(spark, str(early), root, cells, "one")
    seen = []
    monkeypatch.setattr(daily, "read_raw", lambda *a: seen.append(read_raw(*a)) or seen[-1])
    shutil.copy(landing / late, early / late)
    # rows of another date that nothing may read: whoever does fails
    old = {p: p.read_bytes() for p in (tmp_path / "lake/processed/detail").glob("*/*-2024-01-29.csv/*.parquet")}
    for p in old:
        p.write_bytes(b"unreadable")
    second = daily.run_day(spark, str(early), root, cells, "two")
    assert old and all(p.read_bytes() == b"unreadable" for p in old)
    for p, content in old.items():
        p.write_bytes(content)
    assert [f"source_filename={late}/" in f for df in seen for f in df.inputFiles()] == [True]
    assert 0 < second.metrics["processed/detail"]["rows"] < first.metrics["processed/detail"]["rows"]
    third = daily.run_day(spark, str(early), root, cells, "three")
    assert third.metrics["processed/detail"]["rows"] == 0 and len(seen) == 1
    whole = daily.run_day(spark, str(landing), str(tmp_path / "whole"), cells, "all", rebuild=True)

    def table(run, name):  # sums over all dates add up in another order
        df = spark.read.parquet(run.path(name))
        return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in sorted(df.dtypes)])

    for name in daily.TABLES:
        a, b = table(second, name), table(whole, name)
        assert a.select(*b.columns).exceptAll(b).count() == 0 and a.count() == b.count(), name
    observed = {(r.dataset, r.check_name): r.passed for r in spark.read.parquet(second.path("logs/quality")).collect()}
    assert observed["clean", "exact row count"] and observed["hourly grid", "exact row count"]
    assert observed["enriched", "join keeps rows"] and observed["warehouse", "broken constraints"]


def test_exports_and_delivery_summary(spark, run):
    daily.export_csv(spark, run)
    head = spark.read.text(run.path("exports/grid_hour_activity")).first()[0]
    assert head.startswith("timestamp,date,hour,day_of_week,grid_id,sms_in")
    per_file = daily.delivery_summary(spark, run, Zones(run.root))
    assert per_file.count() == 25
    totals = spark.read.json(run.path("logs/delivery_totals")).first()
    assert (totals.unique_source_filename, totals.column_count, totals.invalid_timestamps) == (25, 9, 0)
    assert totals.row_count == run.metrics["processed/detail"]["rows"]


def test_validation_without_routing(spark, landing, tmp_path):
    rows = daily.validate_landing(spark, str(landing), str(tmp_path / "v")).collect()
    assert len(rows) == 30 and sum(r.valid for r in rows) == 25
    assert {r.reason for r in rows if r.valid} == {"Validation passed"}


def test_discovery_by_schema(spark, run):
    found = tables.discover(spark, run.path("analytics"))
    assert set(GRID_PERFORMANCE_COLUMNS) <= set(found["grid"].columns)
    assert set(TEMPORAL_PERFORMANCE_COLUMNS) <= set(found["temporal"].columns)
    with pytest.raises(ValueError):
        tables.discover(spark, run.path("warehouse"))
    assert tables.read_tree(spark, run.path("processed/hourly_grid")).count() == run.metrics["processed/hourly_grid"]["rows"]


def test_missing_and_empty_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "empty"))
    rows = tables.present(spark, {"a": str(tmp_path / "none"), "b": str(tmp_path / "empty")}).collect()
    assert [r.present for r in rows] == [False, False]


def test_one_date_is_rebuilt_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int").withColumn("date", F.to_date("d"))
    sinks.replace_partitions(df, path)
    sinks.replace_partitions(df.where("v = 2").withColumn("v", F.lit(20)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 20]
    sinks.append_partitions(df.withColumn("date", F.to_date(F.lit("2024-01-03"))), path)
    assert spark.read.parquet(path).count() == 4


def test_verify_and_csv_round_trip(spark, tmp_path):
    path, geometry = str(tmp_path / "t"), '{"type":"Polygon","coordinates":[[[1,2],[3,"a\\"b"]]]}'
    df = spark.createDataFrame([(1, geometry), (2, None)], "grid_id long, geometry string")
    assert sinks.write_zone(df, path, "analytics")["rows"] == 2
    sinks.verify(spark, path, 2, df.columns, ("grid_id",))
    for kwargs in (dict(expected_rows=3), dict(expected_rows=2, columns=["x"]),
                   dict(expected_rows=2, not_null=("geometry",))):
        with pytest.raises(ValueError):
            sinks.verify(spark, path, **kwargs)
    sinks.write_csv(df, str(tmp_path / "csv"))
    import csv
    import glob
    rows = [r for p in glob.glob(str(tmp_path / "csv" / "*.csv")) for r in csv.reader(open(p))][0:]
    assert ["1", geometry] in rows


def test_cut_reads_back_what_it_wrote(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1, None)], "t timestamp_ntz, a long, b string")
    back = cut(df)
    assert back.collect() == df.collect() and back.schema.simpleString() == df.schema.simpleString()
    assert scratch_root(spark) in back.inputFiles()[0]


def test_gate_states_are_the_ledger_states(spark):
    assert {gate.REJECTED, gate.REJECTED_AGAIN} == {"REJECTED", "REJECTED_DUPLICATE"}


def test_damaged_reference_fails_the_run(spark, sf, landing, tmp_path):
    """Checks see the reference as delivered: a cell twice, one without id, one without geometry."""
    def feature(cell, geometry):
        return {"type": "Feature", "properties": {"cellId": cell}, "geometry": geometry}

    cells = fixture.cell_lookup(spark, sf).orderBy("grid_id").collect()
    good = [feature(r.grid_id, json.loads(r.geometry)) for r in cells]
    bad = [feature(cells[0].grid_id, good[0]["geometry"]), feature(None, good[0]["geometry"]), feature("7x", good[0]["geometry"]), feature(99_999, None)]
    failing = {}
    for name, features in (("good", good), ("bad", good + bad)):
        path = tmp_path / f"{name}.geojson"
        path.write_text(json.dumps({"type": "FeatureCollection" if name == "good" else "Other", "features": features}))
        done = daily.run_day(spark, str(landing), str(tmp_path / name), str(path), "r")
        stored = spark.read.parquet(done.path("logs/quality")).where("dataset = 'reference' and not passed")
        failing[name] = {(r.check_name, int(float(r.observed))) for r in stored.collect()}
    assert failing["good"] == set()
    n = len(good + bad)
    assert failing["bad"] == {("features outside a collection", n), ("missing ids", 1), ("ids not integer", 1),
                              ("ids more than once", 1), ("missing geometry", 1)}
    totals = spark.read.json(done.path("logs/delivery_totals")).first()
    assert totals.row_count == read_raw(spark, Zones(done.root)).count()
    assert spark.read.json(done.path("logs/delivery_files")).count() == totals.unique_source_filename
