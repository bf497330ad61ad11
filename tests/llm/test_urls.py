import random
import re

from pyspark.sql import functions as F

from gridpulse.llm import urls

CASES = {
    "http://a.org/x": ("a.org", "/x", "org/", "allow"), "http://a.org": ("a.org", "", None, "allow"),
    "http://www.Example.ORG/es/casino": ("www.example.org", "/es/casino", "example.org/es/", "block"),
    "http://example.org/en/12?q#f": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"), "http://x.com/fr/casino": ("x.com", "/fr/casino", "com/fr/", "allow"),
    "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"), "http://x.com/DE/": ("x.com", "/DE/", None, "allow"),
    "http://myexample.net/casino": ("myexample.net", "/casino", None, "block"), "http://casinoroyale.net/": ("casinoroyale.net", "/", None, "allow"),
    "http://x.net/free/free": ("x.net", "/free/free", None, "allow"), "http://x.net/free-bets": ("x.net", "/free-bets", None, "block"),
    "http://x.net?u=http://y.org/": ("x.net", "", None, "allow"), "no scheme casino": ("", "", None, "block"), "": ("", "", None, "allow"),
    None: ("", "", None, "allow"), "a://": ("", "", None, "allow"), "x://h#/p": ("h", "", None, "allow"), "http://É.net/a": ("É.net", "/a", None, "allow"),
    "http://x.net/" + "a" * 100_000 + "/XXX": ("x.net", "/" + "a" * 100_000 + "/XXX", None, "block"),
}


def test_cases(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(CASES)] + [(None, "http://a.org/"), (0, "http://a.org/x")], "page_id bigint, url string")
    got = urls.judge(pages.withColumn("strict_hits", F.lit(9)).withColumn("host", F.lit("clash"))).collect()
    by_url = {r.url: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == len(CASES) + 2 and {u: by_url[u] for u in CASES} == CASES


def test_terms_are_counted_with_boundaries(spark):
    pages = spark.createDataFrame([("http://free.free-x.net/cheap_pills/porn,xxx/porno",)], "url string")
    row = urls.term_counts(pages, urls.default_vocabulary(spark)).first()
    assert (row.strict_hits, row.soft_terms, row.soft_weight) == (2, 3, 3)


def test_large_vocabulary_in_blocks(spark, tmp_path):
    """5,000 terms from files, in one automaton and in seven, against a plain reading of every URL."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcde", k=rng.randint(2, 7))) for _ in range(6000)]
    rows = {w: (rng.choice(["strict"] + ["soft"] * 30), rng.randint(1, 3)) for w in words[:5000]}
    (tmp_path / "terms.csv").write_text(
        "term,class,weight\n" + "".join(f"{w.upper()},{c},{n}\n" for w, (c, n) in rows.items()) + "zz,other,1\n,soft,1\nqq,soft,\nqq,strict,1\n")
    rows["qq"] = ("strict", 1)
    links = [f"http://h.net/{'-'.join(rng.choices(words, k=3))}" for _ in range(400)] + ["http://h.net/zz", "http://h.net/QQ", None]
    pages = spark.createDataFrame(list(enumerate(links)), "page_id bigint, url string")
    terms = urls.read_vocabulary(spark, str(tmp_path / "terms.csv"))
    for block in (urls.BLOCK_TERMS, 800):
        for r in urls.judge(pages, vocabulary=terms, soft_needed=5, block_terms=block).collect():
            found = [rows[w] for w in set(re.findall("[a-z]+", (r.url or "").lower())) if w in rows]
            hard, soft = [c for c, _ in found if c == "strict"], [n for c, n in found if c == "soft"]
            assert (r.soft_terms, r.soft_weight, r.strict_hits > 0) == (len(soft), sum(soft), bool(hard))
            assert r.verdict == ("block" if hard or (len(soft) >= 2 and sum(soft) >= 5) else "allow")


def test_empty_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://x.net/casino"), (2, "http://x.com/de/")], "page_id bigint, url string")
    none = spark.createDataFrame([], urls.VOCABULARY)
    assert {r.page_id: r.verdict for r in urls.judge(pages, vocabulary=none).collect()} == {1: "allow", 2: "block"}


def test_empty(spark):
    assert urls.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0
