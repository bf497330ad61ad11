"""Cell polygons from GeoJSON.

A FeatureCollection is one JSON document, often one line, so neither lines nor rows cut it. It is read in pieces that end
at a closing brace: a file of any size is split, and a piece is a few hundred bytes. Running counts, first inside each
split and then over splits, tell which pieces start inside a string and how deep in braces and brackets each one is. A
piece that closes an object in an array of the document ends a feature; only the pieces of one feature meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from gridpulse.operators.sizes import broadcast_if_small
from gridpulse.sources.delimited import file_name
from gridpulse.sources.records import assembled, numbered, quote_states
from gridpulse.sources.scratch import cut

# geometry is declared as text: the reader then keeps the JSON of the object,
# whatever its type, and nothing has to be inferred
_PROPERTIES = "struct<cellId:string>"
_FEATURE = f"struct<type:string,properties:{_PROPERTIES},geometry:string>"
_SPLIT = ["filename", "split"]
_ROW_LIMIT = 1 << 29  # characters of one feature, near what a row can hold


def read_features(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """(document_type, cell_id, geometry) of every feature, nothing dropped.

    The usual file is one FeatureCollection document, read by as many tasks as it has splits. ``one_per_line`` reads a
    file of single features instead. What is no object of type Feature is left out.
    """
    if one_per_line:
        rows = spark.read.schema(f"properties {_PROPERTIES}, geometry string").json(path)
        return rows.select(
            F.lit("FeatureCollection").alias("document_type"),
            F.col("properties.cellId").alias("cell_id"), "geometry",
        )
    return document_features(pieces(spark, path))


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(filename, split, position, value) between closing braces, in file order inside a split."""
    found = spark.read.option("lineSep", "}").text(path).select(
        file_name().alias("filename"), F.col("_metadata.file_block_start").alias("split"), "value")
    return found.withColumn("position", F.monotonically_increasing_id())


def _outside(text: Column) -> Column:
    """A piece without its strings; ``quoted`` tells whether it starts in one."""
    parts = F.split(F.regexp_replace(text, r"\\.", ""), '"', -1)
    return F.array_join(F.filter(parts, lambda p, i: (i + F.col("quoted")) % 2 == 0), "")


def _count(text: Column, *marks: str) -> Column:
    return sum((F.length(text) - F.length(F.replace(text, F.lit(m), F.lit(""))) for m in marks[1:]),
               F.length(text) - F.length(F.replace(text, F.lit(marks[0]), F.lit(""))))


def _levelled(found: DataFrame) -> DataFrame:
    """Adds braces, brackets: how many are open before a piece; ended: does its closing brace stand outside strings."""
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '[^"]', "")) % 2
    told = quote_states(found, quotes, 1 - quotes)
    bare = told.withColumn("_bare", _outside(F.col("value"))).withColumn("ended", (F.col("quoted") + quotes) % 2 == 0)
    steps = cut(bare.withColumns({
        "_braces": _count(F.col("_bare"), "{") - F.col("ended").cast("int"),
        "_brackets": _count(F.col("_bare"), "[") - _count(F.col("_bare"), "]")}))
    sums = [F.sum(c).alias(c) for c in ("_braces", "_brackets")]
    over = W.partitionBy("filename").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    starts = cut(steps.groupBy(*_SPLIT).agg(*sums).select(*_SPLIT, *(
        F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"{c}_start") for c in ("_braces", "_brackets"))))
    ahead = W.partitionBy(*_SPLIT).orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    return steps.join(broadcast_if_small(starts), _SPLIT).select(
        *found.columns, "_bare", "ended", "_braces", "_brackets",
        *((F.col(f"{c}_start") + F.coalesce(F.sum(c).over(ahead), F.lit(0))).alias(c[1:]) for c in ("_braces", "_brackets")))


def document_features(found: DataFrame) -> DataFrame:
    """Features of the documents whose pieces are given."""
    levelled = cut(_levelled(found))
    after = {c: F.col(c) + F.col(f"_{c}") for c in ("braces", "brackets")}
    # an object of an array of the document closes here
    closes = F.col("ended") & (after["braces"] == 1) & (after["brackets"] == 1)
    first = F.lag(closes.cast("int")).over(W.partitionBy(*_SPLIT).orderBy("position"))
    # the first piece of a split starts a record only where the split before ended one
    edges = levelled.groupBy(*_SPLIT).agg(F.max_by(closes.cast("int"), "position").alias("_closed")).select(
        *_SPLIT, F.lag("_closed", 1, 1).over(W.partitionBy("filename").orderBy("split")).alias("_before"))
    begun = levelled.join(broadcast_if_small(cut(edges)), _SPLIT).withColumns({
        "_starts": F.coalesce(first, F.col("_before")) == 1, "_within": (F.col("brackets") > 0) | (after["brackets"] > 0)})
    # the brace that ended a piece belongs to it; what stands before the array is no part of its first feature
    text = F.when(F.col("brackets") == 0, F.regexp_replace("value", r'(?s)\A.*?"features"\s*:\s*\[', "")).otherwise(F.col("value"))
    records = numbered(begun.select(*_SPLIT, "position", F.concat(text, F.lit("}")).alias("value"), "_within", "_starts"), F.col("_starts"))
    whole = assembled(records.where("_within").drop("_within", "_starts"), "", _ROW_LIMIT)
    parsed = whole.select("filename", F.from_json(F.regexp_replace("value", r"\A[\s,]+", ""), _FEATURE).alias("f"))
    return parsed.where("f.type = 'Feature'").join(broadcast_if_small(cut(document_types(levelled))), "filename", "left").select(
        "document_type", F.col("f.properties.cellId").alias("cell_id"), F.col("f.geometry").alias("geometry"))


def document_types(levelled: DataFrame) -> DataFrame:
    """(filename, document_type): the type member of each document itself, wherever it stands."""
    top = F.when(F.col("braces") == 0, F.regexp_extract("value", r"\A[^{]*\{([^{\[]*)", 1)).when(
        (F.col("braces") == 1) & (F.col("brackets") == 0), F.regexp_extract("value", r"\A([^{\[]*)", 1)).when(
        (F.col("braces") == 1) & (F.col("brackets") == 1), F.regexp_extract("value", r"\A\s*\]([^{\[]*)", 1))
    own = F.regexp_extract(top, r'"type"\s*:\s*"([^"]*)"', 1)
    return levelled.groupBy("filename").agg(F.max(F.when(own != "", own)).alias("document_type"))


def cell_lookup(features: DataFrame) -> DataFrame:
    """(grid_id, geometry) of the usable features.

    The key is the cell id property, not the feature's own 0-based id.
    """
    return features.select(
        F.col("cell_id").try_cast("bigint").alias("grid_id"), "geometry"
    ).where(F.col("grid_id").isNotNull() & F.col("geometry").isNotNull())


def read_lookup(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    return cell_lookup(read_features(spark, path, one_per_line))


def require_cells(lookup: DataFrame) -> DataFrame:
    """The lookup itself; raises when it holds no usable cell."""
    if lookup.isEmpty():
        raise ValueError("the reference holds no cell with an id and a geometry")
    return lookup
