"""Parquet tables: single directories, directory trees, dataset discovery."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.schemas import GRID_PERFORMANCE_COLUMNS, TEMPORAL_PERFORMANCE_COLUMNS


def read_table(spark: SparkSession, path: str, non_empty: bool = True) -> DataFrame:
    """One dataset per directory; raises when it is missing or has no row."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no readable table at {path}") from e
    if non_empty and df.isEmpty():
        raise ValueError(f"table at {path} has no rows")
    return df


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file below a root, as one table."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").parquet(root)
    )


def classify(df: DataFrame) -> str:
    """``grid``, ``temporal`` or ``unknown``, by which columns a table has."""
    have = set(df.columns)
    if have >= set(GRID_PERFORMANCE_COLUMNS):
        return "grid"
    if have >= set(TEMPORAL_PERFORMANCE_COLUMNS):
        return "temporal"
    return "unknown"


def dataset_directories(spark: SparkSession, root: str) -> list[str]:
    """Roots of the datasets below ``root``, from the file index.

    A dataset is the directory above its files, without any ``key=value``
    steps, so all partitions of a table belong to one.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(root)
    )
    parent = F.regexp_replace("path", r"(/[^/=]+=[^/]*)*/[^/]+$", "")
    return sorted(r[0] for r in files.select(parent).distinct().collect())


def discover(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The grid and temporal rollups below a root, found by schema.

    A dataset is a directory with all its partitions, never a single part file.
    Only footers are read. Two datasets of one kind are an error: none is picked
    in silence.
    """
    found: dict[str, DataFrame] = {}
    places: dict[str, str] = {}
    for directory in dataset_directories(spark, root):
        df = spark.read.parquet(directory)
        kind = classify(df)
        if kind == "unknown":
            continue
        if kind in found:
            raise ValueError(f"two datasets of kind {kind}: {places[kind]} and {directory}")
        found[kind], places[kind] = df, directory
    missing = {"grid", "temporal"} - set(found)
    if missing:
        raise ValueError(f"no dataset of kind {sorted(missing)} below {root}")
    return found


def present(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """One row per expected output: does it exist and hold a row."""
    rows = []
    for name, path in outputs.items():
        try:
            read_table(spark, path)
            rows.append((name, True))
        except (FileNotFoundError, ValueError):
            rows.append((name, False))
    return spark.createDataFrame(rows, "output string, present boolean")


def footer_facts(spark: SparkSession, path: str, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Rows, ``min_<column>`` and ``max_<column>`` of a Parquet table from its footers, without reading rows.

    ``by`` may name partition columns. Columns are numbers or dates: footers hold no usable extremes of others. The
    answer belongs to a session of its own, in which the source takes whole aggregates.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    facts = [F.count(F.lit(1)).alias("rows")]
    facts += [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return own.read.parquet(path).groupBy(*by).agg(*facts)
