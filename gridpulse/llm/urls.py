"""URL filtering: host and path rules, then a weighted vocabulary matched by an Aho-Corasick automaton."""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridpulse.llm.url_terms import SOFT, STRICT
from gridpulse.sources.scratch import cut

VOCABULARY = "term string, class string, weight bigint"

SOFT_NEEDED = 2  # different soft terms, and their weight together
BLOCK_TERMS = 200_000  # terms of one automaton

# Fixed values: (verdict, host, path) of the rules in force.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return _lower(host), path


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, else null; a rule fits its host and all subdomains."""
    best = F.lit(None)
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))).otherwise(best)
    return best


def default_vocabulary(spark: SparkSession) -> DataFrame:
    """The terms of ``url_terms``, all soft ones of weight 1."""
    return spark.createDataFrame([(t, "strict", 1) for t in STRICT] + [(t, "soft", 1) for t in SOFT], VOCABULARY)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary from CSV files with the header ``term,class,weight``; class is strict or soft, weight a whole number."""
    return spark.read.csv(path, header=True, schema=VOCABULARY, enforceSchema=False)


def _term_blocks(vocabulary: DataFrame, block_terms: int):
    """The vocabulary as lists of (term, strict, weight) of about ``block_terms``, fetched one at a time."""
    lowered = F.lower(F.col("term").cast("string")).alias("term")
    known = vocabulary.where("class in ('strict', 'soft')").select(lowered, (F.col("class") == "strict").alias("strict"), F.coalesce("weight", F.lit(1)).cast("bigint").alias("weight"))
    terms = cut(known.where("term != ''").groupBy("term").agg(
        F.max("strict").alias("strict"), F.max("weight").alias("weight")))
    n = max(1, -(-terms.count() // block_terms))
    for k in range(n):
        yield [tuple(r) for r in terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == k).collect()]


def term_counts(urls: DataFrame, vocabulary: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Adds strict_hits (occurrences), soft_terms (different terms) and soft_weight (theirs) of the column ``url``.

    A hit has no letter or digit next to it. One scan per URL finds all terms of an automaton; a vocabulary of more than
    about ``block_terms`` terms is that of several, one after another. A term given twice is strict if it is so once, and
    has the larger weight; a null weight is 1; null and empty terms and other classes are ignored.
    """
    names = list(urls.columns)
    counted = urls.withColumns({c: F.lit(0).cast("bigint") for c in ("strict_hits", "soft_terms", "soft_weight")})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema)
    for terms in _term_blocks(vocabulary, block_terms):
        shared = urls.sparkSession.sparkContext.broadcast(terms)
        counted = counted.mapInArrow(_counter(shared, names), kinds)
    return counted


def _counter(shared, names: list[str]):
    def run(batches):
        automaton = ahocorasick.Automaton()
        for term, strict, weight in shared.value:
            automaton.add_word(term, (term, strict, weight))
        automaton.make_automaton()
        for b in batches:
            found = [b.column(c).to_pylist() for c in ("strict_hits", "soft_terms", "soft_weight")]
            for k, url in enumerate(b.column("url").to_pylist() if shared.value else ()):
                text, soft = (url or "").lower(), {}
                for end, (term, strict, weight) in automaton.iter(text):
                    start = end - len(term)
                    if (start < 0 or not text[start].isalnum()) and (end + 1 == len(text) or not text[end + 1].isalnum()):
                        if strict:
                            found[0][k] += 1
                        else:
                            soft[term] = weight
                found[1][k] += len(soft)
                found[2][k] += sum(soft.values())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), *(pa.array(f, pa.int64()) for f in found)],
                [*names, "strict_hits", "soft_terms", "soft_weight"])

    return run


def judge(pages: DataFrame, rules=RULES, vocabulary: DataFrame | None = None, soft_needed: int = SOFT_NEEDED,
          block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per page: page_id, url, host, path, rule, verdict, strict_hits, soft_terms, soft_weight.

    The longest fitting rule decides; without one, a URL is blocked on one strict term of the ``vocabulary`` (term, class,
    weight; by default that of ``url_terms``), or on several different soft terms whose weights reach ``soft_needed``, else
    allowed. A null URL or one without ``://`` has an empty host and path, fits no rule, and is judged on its terms (null
    has none). Repeated rows stay, a null page_id keeps its row, other columns are ignored, and an empty table gives no
    rows; with an empty vocabulary the rules alone decide.
    """
    urls = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    counted = term_counts(urls, default_vocabulary(pages.sparkSession) if vocabulary is None else vocabulary, block_terms)
    host, path = host_and_path(F.col("url"))
    counted = counted.withColumns({"host": host, "path": path})
    ruled = counted.withColumn("_best", longest_rule(F.col("host"), F.col("path"), rules))
    several = (F.col("soft_terms") >= 2) & (F.col("soft_weight") >= soft_needed)
    own = F.when((F.col("strict_hits") > 0) | several, "block").otherwise("allow")
    return ruled.select("page_id", "url", "host", "path", F.col("_best.rule").alias("rule"),
                        F.coalesce("_best.verdict", own).alias("verdict"), "strict_hits", "soft_terms", "soft_weight")


def sql(strict=STRICT, soft=SOFT, soft_needed: int = SOFT_NEEDED, rules=RULES) -> str:
    """The same verdicts for a second engine."""
    bounded = lambda t: f"regexp_matches(lower(coalesce(url, '')), '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')"
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = lambda r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
    pick = lambda k: "CASE " + " ".join(
        f"WHEN {fits(r)} THEN '{(r[0], r[1] + r[2])[k]}'" for r in order) + " END"
    strict_sum = " + ".join(f"CAST({bounded(t)} AS INT)" for t in strict)
    soft_sum = " + ".join(f"CAST({bounded(t)} AS INT)" for t in soft)
    return f"""
WITH cutted AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cutted)
SELECT page_id, host, path, {pick(1)} AS rule,
  coalesce({pick(0)}, CASE WHEN {strict_sum} > 0 OR {soft_sum} >= {soft_needed} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts"""
