import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from gridpulse.llm import bpe
from gridpulse.llm.queries import QUERIES
from tests.llm import brute

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library_and_back(documents, texts, library):
    read = bpe.decode(bpe.encode(documents, PATH), PATH)
    got = brute.by_none([(r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in read.collect()])
    want = brute.by_none([(i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in texts])
    assert got == want


def test_offsets_cut_the_text(spark, library):
    text = "It's 12 o'clock,\n\n  naïve 漢字 🙂"
    row = bpe.encode(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), PATH).first()
    raw = text.encode()
    assert [raw[a:b] for a, b in zip([0, *row.ends], row.ends)] == [library.decode_single_token_bytes(i) for i in row.ids]


def test_pieces_of_odd_texts(library):
    ranks = {library.decode_single_token_bytes(i): i for i in range(library.n_vocab)}
    pick = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'l", "a", "B", "é", "1", "½", "!", " ", " ", "　", "漢", "🙂",
             "́", "ve", "d", " '", "  \n ", "\x00", "\x1c", "\x85", "ͅ", "Ⅷ", "\U000e0001"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    texts += ["z" * 5000, " " * 700 + "a", "'" * 300 + "s", "ab'" * 400, "\n" * 600, "x" * 255 + " " + "y" * 257]
    data, at = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    for text, ends in zip(texts, bpe.piece_ends(bpe.Splitter(bpe.unicode_classes()), data, at)):
        raw, ends = text.encode(), ends.tolist()
        ids = [i for a, b in zip(ends, ends[1:]) for i in bpe.merge(raw[a:b], ranks)]
        assert ids == library.encode_ordinary(text)


def test_long_and_short_merges_agree(library):
    ranks = {library.decode_single_token_bytes(i): i for i in range(library.n_vocab)}
    pick = random.Random(6)
    for _ in range(300):
        piece = bytes(pick.choice(b"abcdeeth ion") for _ in range(pick.randint(2, 150)))
        assert bpe._merge_short(piece, ranks) == bpe._merge_long(piece, ranks)


def test_wrong_ids_or_offsets_are_an_error(spark):
    for ids, ends in (([50_400], [1]), ([0], [2]), ([0, 1], [1])):
        rows = spark.createDataFrame([(ids, ends)], "ids array<int>, ends array<int>")
        with pytest.raises(PythonException):
            bpe.decode(rows, PATH).collect()
    rows = spark.createDataFrame([(None, None, 1)], "ids array<int>, ends array<int>, doc_id int")
    assert bytes(bpe.decode(rows, PATH).first().decoded) == b""


def test_query_digests(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op13_byte_bpe"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty(empty_documents):
    assert bpe.decode(bpe.encode(empty_documents, PATH), PATH).select(F.sha2("decoded", 256)).count() == 0
