"""Daily delivery files: typed rows with lineage, and bare lines for the gate."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridpulse.operators.sizes import broadcast_if_small
from gridpulse.schemas import FILE_PATTERN, RAW_TEXT_SCHEMA
from gridpulse.sources.records import opens_quote, quoted_records
from gridpulse.sources.scratch import cut

# any CSV whose name contains "mi-", whatever the case
LOOSE_PATTERN = "*[mM][iI]-*.[cC][sS][vV]"


def read_deliveries(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """All daily files as one table of text columns with lineage.

    The schema is declared, so no file is read twice and a dirty row cannot
    change a type. ``source_file`` and ``source_filename`` come from the scan.
    """
    return (
        spark.read.schema(RAW_TEXT_SCHEMA)
        .option("header", True).option("mode", "PERMISSIVE")
        .option("pathGlobFilter", pattern).csv(path)
        .withColumns({
            "source_file": F.col("_metadata.file_path"),
            "source_filename": file_name(),
        })
    )


def file_name() -> Column:
    """Name of the file a row came from; the scan reports it percent-encoded."""
    name = F.col("_metadata.file_name")
    # a plus sign is itself in a path, unlike in a query string
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def file_stem(path: Column) -> Column:
    """Base name of a path written with either kind of slash."""
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """One CSV table with header under a declared schema."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def positioned(lines: DataFrame) -> DataFrame:
    """Lines with (filename, split, position); blank lines do not count.

    The id is taken after blank lines are gone, so it is consecutive inside a
    split, in file order.
    """
    return (
        lines.where(F.col("value") != "")
        .withColumn("position", F.monotonically_increasing_id())
    )


def read_lines(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """Physical lines of all matching files, with the file and split each came from; blank ones are left out."""
    return positioned(physical_lines(spark, path, pattern))


def physical_lines(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> DataFrame:
    return with_origin(spark.read.option("pathGlobFilter", pattern).text(path))


def read_records(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """CSV records of all matching files, as :func:`read_lines` gives lines."""
    return joined_records(physical_lines(spark, path, pattern))


def joined_records(lines: DataFrame) -> DataFrame:
    """Lines as positioned records: a quoted line break does not end one.

    Files without such a line keep their lines as they come from the scan. Which files have one is found first, by a
    test that only lines with a quote take; only their lines are shuffled.
    """
    open_ended = cut(lines.where(opens_quote(F.col("value"))).select("filename").distinct())
    plain = positioned(lines)
    if open_ended.isEmpty():
        return plain
    names = broadcast_if_small(open_ended)
    every = lines.withColumn("position", F.monotonically_increasing_id())
    records = quoted_records(every.join(names, "filename", "left_semi"))
    return plain.join(names, "filename", "left_anti").unionByName(records)


def with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        file_name().alias("filename"),
        F.col("_metadata.file_block_start").alias("split"),
        "value",
    )


def list_files(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """Names of the matching files, empty ones included.

    The names are the scan's own file index; no file is opened.
    """
    found = spark.read.option("pathGlobFilter", pattern).text(path).inputFiles()
    names = sorted({unquote(p.rsplit("/", 1)[-1]) for p in found})
    return spark.createDataFrame([(n,) for n in names], "filename string")


def require_files(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> None:
    """Raise when no file matches."""
    if not spark.read.option("pathGlobFilter", pattern).text(path).inputFiles():
        raise FileNotFoundError(f"no file like {pattern} under {path}")
