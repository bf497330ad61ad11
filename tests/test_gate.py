import csv
import math
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import gate
from gridpulse.plans import fixture
from gridpulse.schemas import RAW_COLUMNS, RAW_MEASURES
from gridpulse.sources.delimited import list_files, read_lines, read_records, require_files
from gridpulse.sources.scratch import cut
from gridpulse.streaming import arrivals
from gridpulse.streaming.arrivals import Zones, ingest, ingest_new, read_raw, release_claims

HEADER = ",".join(RAW_COLUMNS)
GOOD = "2013-11-01 00:00:00,1,39,0.5,,1,,2"


def expected_verdict(path):
    """Row-by-row check of one small file, written for the test only."""
    with open(path, newline="") as f:
        rows = [r for r in csv.reader(f) if r]
    if not rows:
        return False, 0, "File is empty"
    header, data = rows[0], rows[1:]
    if header != RAW_COLUMNS:
        missing = [c for c in RAW_COLUMNS if c not in header]
        extra = [c for c in header if c not in RAW_COLUMNS]
        parts = ([f"missing columns: {missing}"] if missing else []) + (
            [f"unexpected columns: {extra}"] if extra else [])
        return False, 0, "; ".join(parts) or "columns are in an unexpected order"

    def broken(n, r):
        if len(r) != 8:
            return f"wrong field count at row {n}"
        v = dict(zip(RAW_COLUMNS, (x.strip() for x in r)))
        if not v["datetime"]:
            return f"missing datetime at row {n}"
        try:
            datetime.strptime(v["datetime"], "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return f"invalid datetime at row {n}: {v['datetime']}"
        if not v["CellID"]:
            return f"missing CellID at row {n}"
        for c in ("CellID", "countrycode"):
            try:
                v[c] and int(v[c])
            except ValueError:
                return f"invalid {c} at row {n}: {v[c]}"
        for c in RAW_MEASURES:
            if v[c]:
                try:
                    x = float(v[c])
                except ValueError:
                    return f"non-numeric {c} at row {n}: {v[c]}"
                if not math.isnan(x) and x < 0:
                    return f"negative {c} at row {n}: {x}"
        return None

    for n, r in enumerate(data, 1):
        reason = broken(n, r)
        if reason:
            return False, n, reason
    if not data:
        return False, 0, "File contains header but no data rows"
    return True, len(data), "Minimum quality checks passed"


CONTENT = {
    "good": [HEADER, GOOD, GOOD],
    "empty": [],
    "header-only": [HEADER],
    "missing": [HEADER.replace(",internet", ""), GOOD],
    "extra": [HEADER + ",x", GOOD],
    "order": [HEADER.replace("smsin,smsout", "smsout,smsin"), GOOD],
    "renamed": [HEADER.replace("CellID", "cellid").replace("callin", "call_in"), GOOD],
    "quoted": ['"datetime",' + HEADER.split(",", 1)[1], '"2013-11-01 00:00:00",1,39,"0.5",,1,,2'],
    "header-twice": [HEADER, GOOD, HEADER, GOOD],
    "blank-lines": [HEADER, "", GOOD, "", "", GOOD.replace("39", "3x")],
    "unpadded": [HEADER, "2013-1-1 0:0:0,+7, 39 ,.5,5.,1e3,1_000,nan"],
    "inf": [HEADER, "2013-11-01 00:00:00,1,,inf,Infinity,-0.0,NaN,"],
    "no-datetime": [HEADER, GOOD, " ,1,39,1,1,1,1,1"],
    "bad-datetime": [HEADER, GOOD, GOOD, "2013-11-31 00:00:00,1,39,1,1,1,1,1"],
    "no-cell": [HEADER, "2013-11-01 00:00:00,,39,1,1,1,1,1"],
    "bad-cell": [HEADER, "2013-11-01 00:00:00,1.0,39,1,1,1,1,1"],
    "big-cell": [HEADER, "2013-11-01 00:00:00,123456789012345678901234567890,39,1,1,1,1,1"],
    "java-suffix": [HEADER, "2013-11-01 00:00:00,1,39,1d,1,1,1,1"],
    "text-measure": [HEADER, GOOD, "2013-11-01 00:00:00,1,39,1,one,-1,1,1"],
    "negative": [HEADER, GOOD, "2013-11-01 00:00:00,1,39,1,1,1,-2.5,x"],
    "neg-inf": [HEADER, "2013-11-01 00:00:00,1,39,1,1,1,1,-1e5"],
    "short-row": [HEADER, GOOD, "2013-11-01 00:00:00,1"],
    "long-row": [HEADER, GOOD + ",9"],
    "first-wins": [HEADER, GOOD, "2013-11-01 00:00:00,1,39,-1,1,1,1,1", "x,1,39,1,1,1,1,1"],
    "with space": [HEADER, GOOD],
    "with+plus": [HEADER, GOOD],
    "glob[1]": [HEADER, GOOD],
    "break-around": [HEADER, '"2013-11-01 00:00:00\n","\n1",39,0.5,,1,,2', GOOD],
    "break-inside": [HEADER, GOOD, '2013-11-01 00:00:00,1,39,"1\n\n2",,1,,2', GOOD],
    "break-then-bad": [HEADER, '2013-11-01 00:00:00,1,"39\n\n\n",0.5,,1,,2', "", GOOD, GOOD.replace("39", "3x")],
    "break-in-header": [HEADER.replace("CellID", '"Cell\nID"'), GOOD],
    "two-breaks": [HEADER, '"2013-11-01 00:00:00\n","1\n",39,"0.5\n",,1,,"2\n"', GOOD, GOOD + ",9"],
    "never-closed": [HEADER, GOOD, '2013-11-01 00:00:00,1,39,"0.5,,1,,2', GOOD, "", GOOD],
    "closed-at-the-end": [HEADER, GOOD, GOOD, GOOD.replace(",2", ',"2')],
    "quote-in-the-middle": [HEADER, '2013-11-01 00:00:00,1,39,0"5,,1,,2', GOOD],
    "quotes-in-two-fields": [HEADER, '2013-11-01 00:00:00,1,39,0"5,,1"2,,2', GOOD],
    "text-after-quote": [HEADER, '2013-11-01 00:00:00,"1"2,39,0.5,,1,,"2"', GOOD],
    "doubled-quotes": [HEADER, '2013-11-01 00:00:00,1,39,"a""b\n""",,1,,2', GOOD],
    "tabs": [HEADER, "2013-11-01 00:00:00\t,\t1,39,0.5,,1,,2"],
}


@pytest.fixture
def landing(tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    for name, lines in CONTENT.items():
        (d / f"sms-call-internet-mi-{name}.csv").write_text("".join(line + "\n" for line in lines))
    big = [HEADER] + [GOOD] * 5000
    big[4001] = "2013-11-01 00:00:00,1,39,1,1,1,1,-3"
    (d / "sms-call-internet-mi-big.csv").write_text("\r\n".join(big))
    (d / "sms-call-internet-mi-bigok.csv").write_text("\n".join([HEADER] + [GOOD] * 7000))
    wide = [HEADER] + [GOOD] * 700  # a field of many lines, over several splits, and more rows after it
    wide[300] = '2013-11-01 00:00:00,1,"39' + "\n" * 40_000 + '",1,1,1,1,1'
    (d / "sms-call-internet-mi-wide.csv").write_text("\n".join(wide + [GOOD.replace("39", "3x")]))
    (d / "other.csv").write_text("x\n")
    return d


@pytest.mark.parametrize("split_bytes", ["128m", "9000"])
def test_file_verdicts(spark, landing, split_bytes):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        lines = read_records(spark, str(landing))
        rows = gate.file_verdicts(lines, list_files(spark, str(landing))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.filename: (r.valid, r.row_count, r.reason) for r in rows}
    want = {p.name: expected_verdict(p) for p in landing.glob("sms-*.csv")}
    differing = {n: (got.get(n), w) for n, w in want.items() if got.get(n) != w}
    assert differing == {} and set(got) == set(want)
    assert got["sms-call-internet-mi-big.csv"] == (False, 4001, "negative internet at row 4001: -3.0")


def test_batch_verdicts_wording(spark, landing):
    rows = gate.batch_verdicts(read_lines(spark, str(landing)), list_files(spark, str(landing))).collect()
    texts = {r.file_path: r.reason for r in rows}
    assert texts["sms-call-internet-mi-good.csv"] == "Validation passed"


def test_require_files(spark, landing, tmp_path):
    require_files(spark, str(landing))
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        require_files(spark, str(tmp_path / "none"))


def _statuses(spark, zones):
    rows = spark.read.parquet(zones.ledger).collect()
    return sorted((r.filename, r.status) for r in rows)


def test_routing_reruns_and_zones(spark, landing, tmp_path):
    zones = Zones(str(tmp_path / "lake"))
    first = {r.filename: r for r in ingest(spark, str(landing), zones).collect()}
    good = {n for n, (ok, *_rest) in ((p.name, expected_verdict(p)) for p in landing.glob("sms-*.csv")) if ok}
    assert {n for n, r in first.items() if r.status == "ACCEPTED"} == good
    assert {r.status for n, r in first.items() if n not in good} == {"REJECTED"}

    raw = read_raw(spark, zones)
    counts = {r.source_filename: r["count"] for r in raw.groupBy("source_filename").count().collect()}
    assert counts == {n: first[n].row_count for n in good}
    assert raw.where("datetime = 'datetime'").count() == 0
    kept = spark.read.text(zones.rejected)
    assert kept.where(F.col("source_filename").contains("long-row")).count() == 2  # header and row, as delivered

    second = {r.filename: r for r in ingest(spark, str(landing), zones).collect()}
    assert {second[n].status for n in good} == {"SKIPPED_DUPLICATE"}
    assert {second[n].reason for n in good} == {gate.ALREADY_RAW}
    assert {r.status for n, r in second.items() if n not in good} == {"REJECTED_DUPLICATE"}
    assert all(second[n].reason == first[n].reason for n in second if n not in good)
    assert read_raw(spark, zones).count() == raw.count()
    assert spark.read.parquet(zones.ledger).count() == 2 * len(first)


def test_arrivals_end_as_the_batch_does(spark, landing, tmp_path):
    batch, stream = Zones(str(tmp_path / "a")), Zones(str(tmp_path / "b"))
    ingest(spark, str(landing), batch)
    ingest_new(spark, str(landing), stream, str(tmp_path / "ck"), files_per_batch=10)
    assert _statuses(spark, stream) == _statuses(spark, batch)
    assert read_raw(spark, stream).exceptAll(read_raw(spark, batch)).count() == 0
    (landing / "sms-call-internet-mi-late.csv").write_text(f"{HEADER}\n{GOOD}\n")
    ingest_new(spark, str(landing), stream, str(tmp_path / "ck"))
    assert len(_statuses(spark, stream)) == len(_statuses(spark, batch)) + 1
    assert ("sms-call-internet-mi-late.csv", "ACCEPTED") in _statuses(spark, stream)


def test_table_verdicts_with_one_hot_file(spark):
    """A file that holds most rows: the failing row number is still exact."""
    n = 4000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.lit("b")).otherwise(F.lit("a")).alias("f"), F.col("id").alias("o"),
        F.lit("2013-11-01 00:00:00").alias("datetime"), F.lit("1").alias("CellID"), F.lit("39").alias("countrycode"),
        F.when(F.col("id") >= 3007, F.lit("-1")).otherwise(F.lit("1")).alias("smsin"),
        *[F.lit("1").alias(c) for c in RAW_MEASURES[1:]],
    ).repartition(5)
    got = {r.filename: (r.row_count, r.reason) for r in gate.table_verdicts(rows, "f", ["o"]).collect()}
    first = {f: 1 + sum(1 for i in range(3007) if (i % 10 == 0) == (f == "b")) for f in "ab"}
    first["b"] = 1 + sum(1 for i in range(3010) if i % 10 == 0)
    assert got == {f: (k, f"negative smsin at row {k}: -1.0") for f, k in first.items()}


def test_latest_entries_and_ledger(spark, sf):
    raw = fixture.as_text(fixture.raw_activity(spark, sf))
    verdict = gate.table_verdicts(raw, "source_filename", ["h", "g", "cc"])
    none = verdict.where(F.lit(False))
    entries = gate.ledger_entries(gate.route(verdict, none, none), datetime(2024, 2, 1))
    assert entries.columns == ["filename", "status", "row_count", "reason", "processed_at"]
    assert gate.latest_entries(entries, 3).count() == 3


@pytest.mark.parametrize("split_bytes", ["128m", "200000"])
def test_fields_beyond_the_limit(spark, tmp_path, split_bytes):
    """A quote that is never closed makes the rest of a file one field; only the rows before it are read."""
    folder = tmp_path / "landing"
    folder.mkdir()
    text = {"line": [HEADER, GOOD, "2013-11-01 00:00:00,1,39," + "9" * 131_073 + ",1,1,1,1"], "fits": [HEADER, GOOD.replace("39", "3" * 131_072)],
            "rest": [HEADER, GOOD, GOOD, '2013-11-01 00:00:00,1,39,"1,1,1,1,1', *[GOOD] * 60_000]}
    for name, lines in text.items():
        (folder / f"sms-call-internet-mi-{name}.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        rows = gate.file_verdicts(read_records(spark, str(folder)), list_files(spark, str(folder))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.filename[len("sms-call-internet-mi-"):-4]: (r.valid, r.row_count, r.reason) for r in rows}
    limit = "Quality validation error: field larger than field limit (131072)"
    assert got == {"line": (False, 1, limit), "rest": (False, 2, limit), "fits": (True, 1, "Minimum quality checks passed")}


def test_two_runs_at_once_take_a_name_once(spark, tmp_path, monkeypatch):
    """Both runs read the ledger before either writes: every file is taken by one of them."""
    folder = tmp_path / "landing"
    folder.mkdir()
    for k in range(6):
        (folder / f"sms-call-internet-mi-{k}.csv").write_text(f"{HEADER}\n{GOOD if k else 'x'}\n")
    zones, meet, found, failed = Zones(str(tmp_path / "lake")), threading.Barrier(2), {}, []
    read = arrivals.read_ledger

    def together(*args):
        ledger = cut(read(*args))
        meet.wait(60)
        return ledger

    def run(name):
        try:
            found[name] = {r.filename: r for r in ingest(spark, str(folder), zones, owner=name).collect()}
        except Exception as e:
            failed.append(e)

    monkeypatch.setattr(arrivals, "read_ledger", together)
    runs = [threading.Thread(target=run, args=(n,)) for n in "ab"]
    [t.start() for t in runs]
    [t.join() for t in runs]
    assert not failed
    for name in found["a"]:
        pair = {found["a"][name].status, found["b"][name].status}
        assert pair == ({"REJECTED", "REJECTED_DUPLICATE"} if name.endswith("-0.csv") else {"ACCEPTED", "SKIPPED_DUPLICATE"})
    monkeypatch.undo()
    assert read_raw(spark, zones).count() == 5
    assert sorted(s for _, s in _statuses(spark, zones)) == ["ACCEPTED"] * 5 + ["REJECTED", "REJECTED_DUPLICATE"] + ["SKIPPED_DUPLICATE"] * 5


def test_claims_of_a_run_that_broke_off(spark, tmp_path, monkeypatch):
    """The same run goes on with its claims; another one must have them released first."""
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "sms-call-internet-mi-a b.csv").write_text(f"{HEADER}\n{GOOD}\n")
    zones = Zones(str(tmp_path / "lake"))

    def fail(*_):
        raise RuntimeError("broke off")

    monkeypatch.setattr(arrivals, "write_zone", fail)
    with pytest.raises(RuntimeError, match="broke off"):
        ingest(spark, str(folder), zones, owner="one")
    monkeypatch.undo()
    assert [r.status for r in ingest(spark, str(folder), zones, owner="two").collect()] == ["SKIPPED_DUPLICATE"]
    assert [r.status for r in ingest(spark, str(folder), zones, owner="one").collect()] == ["ACCEPTED"]
    (folder / "sms-call-internet-mi-c.csv").write_text(f"{HEADER}\n{GOOD}\n")
    monkeypatch.setattr(arrivals, "write_zone", fail)
    with pytest.raises(RuntimeError, match="broke off"):
        ingest(spark, str(folder), zones, owner="three")
    monkeypatch.undo()
    assert release_claims(spark, zones) == 1
    assert sorted(r.status for r in ingest(spark, str(folder), zones).collect()) == ["ACCEPTED", "SKIPPED_DUPLICATE"]
