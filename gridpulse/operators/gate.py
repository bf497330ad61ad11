"""File-level quality gate: verdict per file, routing, ledger entries.

A verdict needs the 1-based number of the first failing row in each file. No
file is ever sorted or numbered as a whole: lines carry (split, position), the
position being consecutive inside a split, and one aggregate per (file, split)
keeps the row count, the first position and the first failure. What precedes a
split is then a sum over splits, so a file that holds most of all rows is
spread over its splits. Rows with a given order need no positions at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from gridpulse.functions.rowrules import (
    BATCH_PASSED, EMPTY_FILE, NO_ROWS, PASSED, TOO_LONG, header_failure, line_failure, row_failure, split_line,
)
from gridpulse.operators.sizes import broadcast_if_small
from gridpulse.sources.scratch import cut


def line_split_facts(lines: DataFrame) -> DataFrame:
    """Per (file, split) of text lines: rows, first position and first failure.

    The file's own header is the first line of its first split and no data row.
    A line that equals the header anywhere else is a row like any other, and
    fails as one. Where each file starts is found first and stored, one row per
    file, so no list of positions is ever gathered.
    """
    parsed = lines.select(
        "filename", "split", "position", "value", line_failure(F.col("value")).alias("failure"))
    # where a file starts: one row per file, from its first split only
    starts = cut(parsed.where(F.col("split") == 0).groupBy("filename").agg(
        F.min(F.struct("position", "value")).alias("head")))
    marked = parsed.join(
        broadcast_if_small(starts.select("filename", F.col("head.position").alias("_start"))), "filename", "left")
    data = ~((F.col("split") == 0) & F.col("position").eqNullSafe(F.col("_start")))
    broken = data & F.col("failure").isNotNull()
    facts = marked.groupBy("filename", "split").agg(
        F.count_if(data).alias("rows"),
        F.min(F.when(data, F.col("position"))).alias("start"),
        F.min(F.when(broken, F.struct("position", "failure"))).alias("bad"),
    )
    heads = starts.select("filename", header_failure(split_line(F.col("head.value"))).alias("header_reason"))
    return facts.join(heads, "filename", "left")


def verdicts(facts: DataFrame, passed_text: str = PASSED) -> DataFrame:
    """One row per file: filename, valid, row_count, reason.

    ``row_count`` is the total for a valid file, the number of the first
    failing row for a file with a bad row, and 0 for a refused header. A row
    with a field beyond the limit cannot be read: only those before it count.
    """
    if "header_reason" not in facts.columns:
        facts = facts.withColumn("header_reason", F.lit(None).cast("string"))
    ahead = W.partitionBy("filename").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    located = facts.withColumn(
        "row_no",
        F.when(F.col("bad").isNotNull(),
               F.coalesce(F.sum("rows").over(ahead), F.lit(0))
               + F.col("bad.position") - F.col("start") + 1),
    )
    per_file = located.groupBy("filename").agg(
        F.sum("rows").alias("rows"),
        F.max("header_reason").alias("header_reason"),
        F.min(F.when(F.col("row_no").isNotNull(),
                     F.struct("row_no", F.col("bad.failure").alias("failure")))).alias("first"),
    )
    unread = F.col("first.failure.label") == TOO_LONG
    failing = F.when(unread, TOO_LONG).otherwise(F.concat(
        F.col("first.failure.label"), F.lit(" at row "), F.col("first.row_no").cast("string"), F.col("first.failure.detail")))
    header_bad = F.col("header_reason").isNotNull()
    row_bad = F.col("first").isNotNull()
    no_rows = F.col("rows") == 0
    return per_file.select(
        "filename",
        (~header_bad & ~row_bad & ~no_rows).alias("valid"),
        F.when(header_bad, F.lit(0)).when(row_bad, F.col("first.row_no") - unread.cast("int"))
        .otherwise(F.col("rows")).cast("bigint").alias("row_count"),
        F.when(header_bad, F.col("header_reason")).when(row_bad, failing)
        .when(no_rows, F.lit(NO_ROWS)).otherwise(F.lit(passed_text)).alias("reason"),
    )


def table_verdicts(rows: DataFrame, file: str, order: list[str], passed_text: str = PASSED) -> DataFrame:
    """Verdicts of deliveries already held as rows of text columns, whose order is given.

    Two aggregates that combine map-side, no sort and no shuffle of rows: the
    smallest order key of a failing row per file, then how many rows of the
    file come no later. One row per file with a failure is stored in between.
    """
    at = F.struct(*[F.col(c) for c in order])
    checked = rows.select(F.col(file).alias("filename"), at.alias("_at"), row_failure().alias("failure"))
    bad = cut(checked.where(F.col("failure").isNotNull()).groupBy("filename").agg(
        F.min(F.struct("_at", "failure")).alias("first")))
    placed = rows.select(F.col(file).alias("filename"), at.alias("_at")).join(
        broadcast_if_small(bad.select("filename", F.col("first._at").alias("_bad"))), "filename", "left")
    counts = placed.groupBy("filename").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_at") <= F.col("_bad")).alias("row_no"))
    found = F.col("first").isNotNull()
    failing = F.concat(F.col("first.failure.label"), F.lit(" at row "), F.col("row_no").cast("string"), F.col("first.failure.detail"))
    return counts.join(bad, "filename", "left").select(
        "filename", (~found).alias("valid"), F.when(found, F.col("row_no")).otherwise(F.col("rows")).alias("row_count"),
        F.when(found, failing).otherwise(F.lit(passed_text)).alias("reason"))


def file_verdicts(lines: DataFrame, names: DataFrame | None = None, passed_text: str = PASSED) -> DataFrame:
    """Verdicts of delivered files from their text lines.

    ``names`` lists the files that exist; one without any line is empty.
    """
    found = verdicts(line_split_facts(lines), passed_text)
    if names is None:
        return found
    return names.select("filename").join(found, "filename", "left").select(
        "filename",
        F.coalesce("valid", F.lit(False)).alias("valid"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce("reason", F.lit(EMPTY_FILE)).alias("reason"),
    )


def batch_verdicts(lines: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Verdicts without routing; a valid file reads ``Validation passed``."""
    return file_verdicts(lines, names, BATCH_PASSED).withColumnRenamed("filename", "file_path")


# Ledger states and the reason of a repeated valid delivery.
ACCEPTED, SKIPPED = "ACCEPTED", "SKIPPED_DUPLICATE"
REJECTED, REJECTED_AGAIN = "REJECTED", "REJECTED_DUPLICATE"
ALREADY_RAW = "File already exists in raw; not overwritten"


def route(verdict: DataFrame, in_raw: DataFrame, in_rejected: DataFrame) -> DataFrame:
    """Status and zone per file, given the names each zone already holds."""
    raw = in_raw.select("filename").distinct().withColumn("_raw", F.lit(True))
    bad = in_rejected.select("filename").distinct().withColumn("_bad", F.lit(True))
    known = verdict.join(raw, "filename", "left").join(bad, "filename", "left")
    seen_raw, seen_bad = F.col("_raw").isNotNull(), F.col("_bad").isNotNull()
    status = (
        F.when(F.col("valid") & seen_raw, SKIPPED).when(F.col("valid"), ACCEPTED)
        .when(seen_bad, REJECTED_AGAIN).otherwise(REJECTED)
    )
    return known.select(
        "filename",
        status.alias("status"),
        F.when(F.col("valid"), "raw").otherwise("rejected").alias("zone"),
        "row_count",
        F.when(F.col("valid") & seen_raw, ALREADY_RAW).otherwise(F.col("reason")).alias("reason"),
    )


def ledger_entries(routed: DataFrame, processed_at) -> DataFrame:
    """Audit rows for one run."""
    return routed.select(
        "filename", "status", "row_count", "reason",
        F.lit(processed_at).cast("timestamp_ntz").alias("processed_at"),
    )


def of_files(rows: DataFrame, files: DataFrame, file: str = "filename") -> DataFrame:
    """The rows of the files that ``files`` lists."""
    return rows.join(files.select(F.col("filename").alias(file)).distinct(), file, "left_semi")


def rows_of(rows: DataFrame, routed: DataFrame, status: str, file: str = "filename") -> DataFrame:
    """The rows of all files with this status; a file goes as a whole."""
    return of_files(rows, routed.where(F.col("status") == status), file)


def latest_entries(ledger: DataFrame, n: int = 10) -> DataFrame:
    return ledger.orderBy(F.col("processed_at").desc(), F.col("filename")).limit(n)
