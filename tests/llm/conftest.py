import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="session")
def documents(spark, sf):
    """A small real table with awkward rows: nulls everywhere, empty, very long, ties, repeats, clashing columns."""
    odd = [
        (None, "Some text without id", None, None, None), (-1, None, None, "é", None), (-2, "", "en", "", 0),
        (-3, " \n\t ", "en", "src1", 4), (-4, LONG, None, "src1", None), (-5, LONG + "end", "en", "src1", 1),
        (-6, "tiny", "en", None, 4), (-7, "Tiny", "en", "src2", 4), (-7, "Tiny", "en", "src2", 4), (-8, "z" * 700, "en", "src2", 700),
        (-9, "ab" * 300, "en", "src2", 600), (-10, "mail a.b@c.de.fg or +1 (377) 555-0271, 4111-1111-1111-1111 at 10.0.0.255", "en", "src3", 70),
    ]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    awkward = {"a": 1, "b": 2, "id": 3, "rep": 4, "size": 5, "start": 6, "end": 7, "component": 8, "_id": 9, "score": 10, "label": 11}
    return docs.unionByName(spark.createDataFrame(odd, SCHEMA)).withColumns({n: F.lit(v) for n, v in awkward.items()})


@pytest.fixture(scope="session")
def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
