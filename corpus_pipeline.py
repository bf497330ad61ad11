"""Raw documents to a training mix, in written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.llm import decontaminate, mixing, near_dup, pii, quality
from gridpulse.sources.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Judged by their text alone, a null one as empty; repeated rows go or stay together; columns may have any name.
    """
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column ``row``, whatever their columns are called, beside their doc_id and text hash ``th``."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.select("row", F.col("row.doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.col("row.text").cast("string")).alias("th"))


def _rows(keyed: DataFrame, docs: DataFrame) -> DataFrame:
    return keyed.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents (five-word shingles, similarity 0.8) the one with the smallest doc_id.

    A row stays or goes by its own doc_id and text, so of two texts of one id one may go; two similar ones under the
    group's smallest id leave one of them. Rows without a doc_id stay as they are; of rows that repeat a kept doc_id and
    its text one stays. Null and empty texts are no duplicates of each other. Other columns may have any name.
    """
    kept = near_dup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id", "th").distinct().hint("merge")
    keyed = _keyed(docs)
    named = keyed.join(kept, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    return _rows(named.unionByName(keyed.where("doc_id is null")), docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark.

    A row goes by its own doc_id (null included) and text; repeated rows go or stay together; rows without a text stay.
    Other columns may have any name.
    """
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("th").alias("bad_th")).distinct().hint("merge")
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("th") == F.col("bad_th"))
    return _rows(_keyed(docs).join(bad, same, "left_anti"), docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind.

    Null texts stay null, rows without an id or repeated stay; n_chars follows the text. Columns may have any name.
    """
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of each, its source's size and target.

    The columns size, source_size, target and taken are those of the mix, also where the input has such names. Rows
    without words are taken with 0, a null source is a source of its own.
    """
    return mixing.mix(docs, whole=True)


STAGES = [
    ("quality_classifier", good_documents),
    ("near_dedup", one_of_each_group),
    ("decontamination", clean_of_benchmarks),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
]

# Fitted models, neighbour search and hashes are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written as Parquet and read by the next."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
