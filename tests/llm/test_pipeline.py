import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from gridpulse.llm import decontaminate, quality
from tests.conftest import SF
from tests.llm import brute
from tests.llm.test_decontaminate import batch_sizes, long_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None, "Without an id there is text enough to stay here.", None, None, 5), (-1, None, None, None, None), (-1, None, None, None, None)]
    real = spark.read.parquet(f"{SF}/documents.parquet").select(COLUMNS)
    return real.unionAll(spark.createDataFrame(odd, real.schema))


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_quality_stage(spark, docs):
    kept = pipeline.good_documents(spark, docs, SF)
    scores = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert kept.columns == COLUMNS and kept.count() == scores.where("predicted = 1").count()


def test_near_duplicate_stage(spark, docs):
    kept = pipeline.one_of_each_group(spark, docs, SF)
    want = {(i, t) for (i, t), (*_, k) in zip(rows(docs), brute.near_documents(rows(docs), 5, 80)) if k or i is None}
    assert kept.columns == COLUMNS and brute.by_none(rows(kept)) == brute.by_none(want)


def test_benchmark_stage(spark, docs):
    kept = pipeline.clean_of_benchmarks(spark, docs, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [row for row, (_, _, hit, _) in zip(rows(docs), brute.contaminated(rows(docs), items)) if not hit]
    assert kept.columns == COLUMNS and brute.by_none(rows(kept)) == brute.by_none(want)


def test_benchmark_stage_reads_its_index_a_few_rows_at_a_time(spark, tmp_path, monkeypatch):
    seen = []
    match = decontaminate.match
    monkeypatch.setattr(decontaminate, "match", lambda index, *a: seen.extend(batch_sizes(index)) or match(index, *a))
    spark.createDataFrame([(1, "900000 900001 900002")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = pipeline.clean_of_benchmarks(spark, long_documents(spark, 40), str(tmp_path))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [k for k in range(40) if k != 30]
    assert sum(size for _, size in seen) > 12 << 20 and max(size for _, size in seen) < 6 << 20


def test_personal_data_stage(spark, docs):
    clean = pipeline.without_personal_data(spark, docs, SF)
    assert clean.columns == COLUMNS and clean.count() == docs.count()
    assert not any(brute.personal(t) for _, t in rows(clean))
    before = {(i, t) for i, t in rows(docs) if not brute.personal(t)}
    assert before <= set(rows(clean)), "texts without personal data stay as they are"


def test_mixing_stage(spark, docs):
    mix = pipeline.mixed(spark, docs.where("doc_id >= 0"), SF)
    assert mix.count() == docs.where("doc_id >= 0").count() and set(COLUMNS) < set(mix.columns)
    assert all(0 <= r.taken <= 2 * len(brute.WORD.findall(r.text or "")) for r in mix.collect())


def test_mixing_stage_keeps_rows_without_a_key_of_their_own(spark, docs):
    """Null ids, repeated rows and two texts of one id come out once each, with their own size."""
    more = [(None, "a second text of six words", None, "src1", 26), (None, "a second text of six words", None, "src1", 26),
            (-2, "one", "en", "src1", 3), (-2, "two words", "en", "src1", 9), (-3, "five", "en", "src1", 4), (-3, "four", "en", "src1", 4)]
    docs = docs.unionAll(spark.createDataFrame(more, docs.schema))
    one = pipeline.mixed(spark, docs, SF)
    assert one.columns == [*COLUMNS, "size", "source_size", "target", "taken"]
    assert brute.by_none(rows(one)) == brute.by_none(rows(docs))
    got = one.collect()
    assert all(r["size"] == len(brute.WORD.findall(r.text or "")) and 0 <= r.taken <= 2 * r["size"] for r in got)
    two = pipeline.mixed(spark, docs.orderBy("text").repartition(5), SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, two))


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_columns_of_any_name(spark, docs, documents, stage):
    """Columns that operators use inside, and those that a stage adds, do not stop it or change its rows."""
    names = ["_kept", "_id", "_th", "th", "row", "bad_id", "_row", "_tags", "size", "Taken", "target", "source_size", "kept", "rank", "x.y"]
    more = documents.withColumns({n: F.lit(n) for n in names if n not in documents.columns}).withColumn("size", F.lit("size"))
    got = stage(spark, more, SF)
    plain = stage(spark, documents.select(COLUMNS), SF)
    assert brute.by_none(rows(got)) == brute.by_none(rows(plain))
    added = {"size", "source_size", "target", "taken"} if stage is pipeline.mixed else set()
    assert {c.lower() for c in got.columns} == {c.lower() for c in more.columns} | added
    first = got.select("_kept", "`x.y`", F.col("rank")).first()
    assert tuple(first) == ("_kept", "x.y", "rank")


def test_near_duplicates_go_by_row(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    data = [(1, a), (5, a), (5, b), (5, b), (8, a + " x y"), (8, b + " z"), (9, None), (9, ""), (9, "")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    got = brute.by_none(rows(pipeline.one_of_each_group(spark, frame, SF)))
    assert got == brute.by_none([(1, a), (5, b), (9, None), (9, "")])


def test_stages_and_run(spark):
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "personal_data", "mixing"]
    out = entry.queries()["pipeline"](spark, SF)
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.groupBy("doc_id").count().where("count > 1").count() == 0


def test_operators_are_registered():
    assert [n for n in range(1, 14) if sum(bool(re.match(rf"op{n}_", q)) for q in entry.queries()) == 1] == list(range(1, 14))
