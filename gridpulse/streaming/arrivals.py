"""From landing to raw and rejected, in batch or as files arrive.

Both ways share :func:`settle`. Its writes replace the partition of a file, and
the ledger is appended last, so a repeated attempt ends in the same state.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridpulse.functions.rowrules import BLANKS, EMPTY_FILE, split_line
from gridpulse.operators import gate
from gridpulse.schemas import FILE_PATTERN, RAW_COLUMNS, RAW_TEXT_SCHEMA
from gridpulse.sources.delimited import joined_records, list_files, positioned, read_lines, read_records, with_origin
from gridpulse.sources.scratch import cut, scope
from gridpulse.sources.sinks import append_ledger, claim, read_ledger, release, write_zone


@dataclass(frozen=True)
class Zones:
    """Paths of one lake."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    @property
    def ledger(self) -> str:
        return f"{self.root}/logs/ingestion"

    def claims(self, status: str) -> str:
        return f"{self.root}/logs/claims/{status.lower()}"


def delivered_rows(lines: DataFrame) -> DataFrame:
    """Data rows of accepted files. The header is the one line that equals it:
    a file with a second copy would have been refused."""
    # line breaks around a value, inside its quotes, are no part of it
    fields = F.transform(split_line(F.col("value")), lambda f: F.when(
        F.contains(f, F.lit("\n")), F.btrim(f, F.lit(BLANKS))).otherwise(f))
    header = F.array(*[F.lit(c) for c in RAW_COLUMNS])
    return (
        lines.where(F.col("value") != "").withColumn("_f", fields).where(F.col("_f") != header)
        .select(F.col("filename").alias("source_filename"),
                *[F.get("_f", F.lit(i)).alias(c) for i, c in enumerate(RAW_COLUMNS)])
    )


# in a path these are patterns to Spark, so such a name cannot be read by path
GLOB_CHARACTERS = set("*?[]{}\\")


def has_glob_name(names: list[str]) -> bool:
    return any(GLOB_CHARACTERS & set(n) for n in names)


def claimed(spark: SparkSession, routed: DataFrame, zones: Zones, status: str, owner: str) -> DataFrame:
    """Names of files with this status that another run has taken in the meantime."""
    names = (r.filename for r in routed.where(F.col("status") == status).select("filename").toLocalIterator())
    return spark.createDataFrame([(n,) for n in claim(spark, zones.claims(status), names, owner)], "filename string")


def release_claims(spark: SparkSession, zones: Zones) -> int:
    """Free the names that runs took and never recorded, after a failure and while no run is active."""
    ledger = cut(read_ledger(spark, zones.ledger))
    names = lambda s: (r.filename for r in ledger.where(F.col("status") == s).select("filename").distinct().toLocalIterator())
    return sum(release(spark, zones.claims(s), names(s)) for s in (gate.ACCEPTED, gate.REJECTED))


def settle(spark: SparkSession, records: DataFrame, lines: DataFrame, zones: Zones, verdict: DataFrame,
           processed_at: datetime | None = None, owner: str | None = None) -> DataFrame:
    """Route judged files, write the rows of each to its zone, record them; returns the routing.

    Accepted files go as records, refused ones as the lines they were delivered in.

    The ledger tells which names a zone already holds, so no zone is scanned.
    What it does not hold is claimed name by name, so of two runs at once one
    takes a file and the other records a duplicate. ``owner`` names the run: a
    repeated attempt with the same one keeps its claims. Lines find their
    file's status by a join.
    """
    stamp = processed_at or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    ledger = read_ledger(spark, zones.ledger)
    known = {s: ledger.where(F.col("status") == s).select("filename") for s in (gate.ACCEPTED, gate.REJECTED)}
    verdict = cut(verdict)
    # one row per file, needed by the jobs below
    routed = cut(gate.route(verdict, known[gate.ACCEPTED], known[gate.REJECTED]))
    taken = {s: claimed(spark, routed, zones, s, owner or uuid.uuid4().hex) for s in known}
    if not all(t.isEmpty() for t in taken.values()):
        routed = cut(gate.route(verdict, *(known[s].unionByName(taken[s]) for s in (gate.ACCEPTED, gate.REJECTED))))

    def of(rows: DataFrame, status: str) -> DataFrame | None:
        chosen = routed.where((F.col("status") == status) & (F.col("reason") != EMPTY_FILE))
        return None if chosen.isEmpty() else gate.rows_of(rows, routed, status)

    if (good := of(records, gate.ACCEPTED)) is not None:
        write_zone(delivered_rows(good), zones.raw, "raw")
    if (bad := of(lines, gate.REJECTED)) is not None:
        write_zone(bad.select(F.col("filename").alias("source_filename"), "value"), zones.rejected, "rejected")
    append_ledger(gate.ledger_entries(routed, stamp), zones.ledger)
    return routed


def ingest(spark: SparkSession, landing: str, zones: Zones, pattern: str = FILE_PATTERN,
           processed_at: datetime | None = None, owner: str | None = None) -> DataFrame:
    """One batch run over everything in the landing zone."""
    records = read_records(spark, landing, pattern)
    verdict = gate.file_verdicts(records, list_files(spark, landing, pattern))
    return settle(spark, records, read_lines(spark, landing, pattern), zones, verdict, processed_at, owner)


def ingest_new(spark: SparkSession, landing: str, zones: Zones, checkpoint: str,
               pattern: str = FILE_PATTERN, files_per_batch: int = 1000) -> None:
    """Take in files not seen by an earlier call, then return.

    A file belongs to exactly one micro-batch, so its verdict is complete. An
    empty file has no line to arrive with; it is recorded at the end, from the
    names that were there before the stream started.
    """
    listed = list_files(spark, landing, pattern)
    arriving = (
        spark.readStream.option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).text(landing)
    )

    def take(batch: DataFrame, _id: int) -> None:
        session = batch.sparkSession
        with scope(session):  # the stream calls from a thread of its own, outside the caller's scope
            records, lines = joined_records(batch), positioned(batch)
            verdict = cut(gate.file_verdicts(records))
            # bounded by files_per_batch
            names = [r.filename for r in verdict.select("filename").collect()]
            if has_glob_name(names):
                # the file stream reads other files twice next to such a name: its batch is read from the folder
                records, lines = (gate.of_files(read(session, landing, pattern), verdict) for read in (read_records, read_lines))
                verdict = gate.file_verdicts(records)
            # a batch that is tried again finds its own claims
            settle(session, records, lines, zones, verdict, owner=f"{checkpoint}#{_id}")

    run = (
        with_origin(arriving).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.awaitTermination()

    recorded = read_ledger(spark, zones.ledger).select("filename")
    silent = cut(listed.join(recorded, "filename", "left_anti"))
    if not silent.isEmpty():
        no_lines = read_lines(spark, landing, pattern).where(F.lit(False))
        settle(spark, no_lines, no_lines, zones, gate.file_verdicts(no_lines, silent), owner=f"{checkpoint}#silent")


def read_raw(spark: SparkSession, zones: Zones, files: list[str] | None = None) -> DataFrame:
    """Rows of accepted deliveries, as text, with their file: of all, or of some files only.

    The raw zone has a partition per file, so the others are not even listed; a
    name that cannot stand in a path is found by a filter on the partition.
    """
    schema = StructType([*RAW_TEXT_SCHEMA.fields, StructField("source_filename", StringType())])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    if files is None:
        return reader.csv(zones.raw)
    if files and all(re.fullmatch(r"[\w.+-]+", f) for f in files):
        return reader.option("basePath", zones.raw).csv([f"{zones.raw}/source_filename={f}" for f in files])
    return reader.csv(zones.raw).where(F.col("source_filename").isin(files))
