import zlib

import pytest
from pyspark.sql import functions as F

from gridpulse.llm import quality

LABEL = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    return quality.classify(docs, labels).join(labels, "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    held = scored[scored.held_out & scored.quality.notna()]
    assert len(held) > 500 and (held.predicted == held.quality).mean() > 0.97
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert (good[:, None] > bad[None]).mean() + (good[:, None] == bad[None]).mean() / 2 > 0.98


def test_contract(scored):
    assert scored.score.between(0, 1).all() and (scored.predicted == (scored.score >= 0.3)).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()


def test_held_out_labels_do_not_matter(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(150)], LABEL)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, quality.classify(documents, x).select("doc_id", "score").collect()), key=str) for x in (labels, flipped))
    assert one == two


def test_one_class_no_labels_and_odd_labels(spark, documents, empty_documents):
    none = spark.createDataFrame([], LABEL)
    assert {r.score for r in quality.classify(documents, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(99)] + [(1, None, 0), (None, 1, 0), (2, 7, 0)], LABEL)
    assert {r.predicted for r in quality.classify(documents, ones).collect()} == {1}
    assert quality.classify(empty_documents, none).count() == 0
    assert quality.classify(documents, none).count() == documents.count()


def test_filter_keeps_columns_and_agrees(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = quality.keep_good(documents, labels)
    assert kept.columns == documents.columns
    assert kept.count() == quality.classify(documents, labels).where("predicted = 1").count()
