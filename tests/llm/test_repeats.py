import pytest
from pyspark.sql import functions as F

from gridpulse.llm import repeats
from tests.llm import brute


@pytest.mark.parametrize("bucket", [repeats.BUCKET, 1])
def test_equals_brute_force(documents, texts, bucket):
    short = [(i, t) for i, t in texts if not t or len(t) < 60_000]
    docs = documents.where("text is null or length(text) < 60000")
    got = repeats.remove_repeats(docs, bucket=bucket).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert brute.by_none(map(tuple, got)) == brute.by_none(brute.repeats(short))


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 1000)
    docs = [(1, "".join(chr(97 + (i * i + i // 7) % 23) for i in range(5000))), (2, "prefix" + "".join(
        chr(97 + (i * i + i // 7) % 23) for i in range(700, 4200)) + "suffix")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert brute.by_none(map(tuple, got)) == brute.by_none(brute.repeats(docs))


@pytest.mark.parametrize("bucket", [repeats.BUCKET, 1])
def test_many_rows_without_an_id(spark, bucket):
    """Thousands of texts share the null id; each loses its own spans only."""
    shared = "".join(chr(97 + (i * i + i // 7) % 23) for i in range(400))
    word = lambda i, n: " ".join(f"{i}x{k}" for k in range(n))
    docs = [(None, word(i, 60) + (shared[i % 50: i % 50 + 250] if i % 2 else "")) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = repeats.remove_repeats(df, bucket=bucket).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert brute.by_none(map(tuple, got)) == brute.by_none(brute.repeats(docs))


def test_intervals_of_a_prefix_tree():
    assert list(repeats.intervals([3, 5, 5, 2])) == [(5, 1, 3), (3, 0, 3), (2, 0, 4)]
    assert list(repeats.intervals([])) == []


def test_group_needs_left_and_right_extension():
    gram = b"g" * 4
    contexts = [b"xxab" + gram + b"12345", b"yyab" + gram + b"12399", b"zz.." + gram + b"12345"]
    found = repeats.bucket_spans(contexts, [4, 4, 4], 9, 4)
    assert sorted(found) == [(0, 0, 9), (0, 2, 7), (1, 2, 7), (2, 0, 9)]


def test_empty(empty_documents):
    assert repeats.remove_repeats(empty_documents).count() == 0
