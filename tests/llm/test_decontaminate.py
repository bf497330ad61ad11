import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import decontaminate
from tests.llm import brute

ITEM = "item_id bigint, text string"


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 4000])
def test_equals_brute_force(spark, sf, documents, texts, block_bytes):
    odd = spark.createDataFrame([(900, "Tiny"), (901, None), (902, " -- "), (903, "lorem ipsum"), (None, "tiny"), (900, "Tiny")], ITEM)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").unionAll(odd)
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = decontaminate.contamination(documents, bench, block_bytes=block_bytes).collect()
    assert brute.by_none((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == brute.by_none(brute.contaminated(texts, items))
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_proximity_is_reported_apart(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "one two three four"), (3, "one " + "y " * 90 + "two three four")],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, "one two three four")], ITEM)
    got = {r.doc_id: (r.n_hit, r["items"], r.near_items) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (0, [], ["7"]), 2: (4, ["7"], []), 3: (0, [], [])}


def test_segments_and_portions_give_the_same(spark, sf, documents, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = lambda **k: sorted(map(repr, decontaminate.contamination(documents, bench, **k).collect()))
    whole = rows()
    assert rows(segment_bytes=2000) == whole
    monkeypatch.setattr(decontaminate, "CANDIDATES", 3)
    assert rows() == whole


def test_texts_are_indexed_once_for_all_blocks(spark, documents, monkeypatch):
    built = []
    build = decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda *a: built.append(1) or build(*a))
    bench = spark.createDataFrame([(k, f"item {k} lorem ipsum dolor") for k in range(40)], ITEM)
    decontaminate.contamination(documents, bench, block_bytes=1500).count()
    assert len(built) == 1


def long_documents(spark, n):
    """Documents in one partition, each of 30,000 numbers that no other has."""
    first = F.col("id") * 30_000
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.array_join(F.sequence(first, first + 29_999), " ").alias("text"))


def batch_sizes(index):
    """Rows and bytes of the batches in which Python gets the index."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    return [tuple(r) for r in index.mapInArrow(run, "n bigint, size bigint").collect()]


def test_a_task_holds_a_few_rows_of_the_index(spark):
    before = spark.conf.getAll
    index = decontaminate.build_index(long_documents(spark, 40))
    seen = batch_sizes(index)
    assert sum(n for n, _ in seen) == index.count() and sum(size for _, size in seen) > 12 << 20
    assert max(size for _, size in seen) < 6 << 20
    for path in index.inputFiles():
        told = pq.ParquetFile(path.removeprefix("file://")).metadata
        assert all(told.row_group(k).total_byte_size < 6 << 20 for k in range(told.num_row_groups))
    assert spark.conf.getAll == before


def test_result_belongs_to_the_session_of_the_documents(spark):
    docs = long_documents(spark, 3)
    bench = spark.createDataFrame([(1, "30000 30001 30002"), (2, "29999 30000")], ITEM)
    got = decontaminate.contamination(docs, bench)
    assert got.sparkSession is spark
    assert sorted((r.doc_id, r.n_hit, r["items"]) for r in got.join(docs, "doc_id").collect()) == [(0, 0, []), (1, 3, ["1"]), (2, 0, [])]


def test_copies_of_terms_inside_a_window(spark):
    docs = spark.createDataFrame([(1, "a a a b a a a"), (2, "b a"), (3, "a b b a"), (4, "a A a")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "a a b"), (2, "b a"), (3, "a a a")], ITEM)
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (7, ["1", "2", "3"]), 2: (2, ["2"]), 3: (2, ["2"]), 4: (3, ["3"])}


def test_empty(spark, documents, empty_documents):
    none = spark.createDataFrame([], ITEM)
    assert decontaminate.contamination(documents, none).where("contaminated").count() == 0
    assert decontaminate.contamination(documents, none).count() == documents.count()
    assert decontaminate.contamination(empty_documents, none).count() == 0
