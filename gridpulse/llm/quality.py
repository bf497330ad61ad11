"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark column expressions.

1. Statistics of every whole text, as built-in expressions (one pass, stored as a narrow table).
2. A small forest is trained on labelled rows; every path from a root is a rule, a conjunction of thresholds.
3. A logistic regression with an L1 penalty weighs rules and drops most of them.
4. What is left is a sum of comparisons, compiled to a column, so scoring is a projection.

Training reads at most about ``train_rows`` labelled rows, chosen by a hash of the id when there are more.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.functions.columns import let
from gridpulse.sources.scratch import cut

TRAIN_ROWS = 20_000
TREES, DEPTH, PENALTY = 12, 3, 5e-4
THRESHOLD = 0.3

Condition = tuple[str, bool, float]  # statistic, at most (else above), threshold


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; all are finite, and 0 where there is nothing to count."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = _count(text, r"\S+")
    per_word = F.greatest(words, F.lit(1.0))
    return {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "chars_per_word": F.length(text) / per_word,
        "upper": _count(text, r"\p{Lu}") / chars,
        "bangs": _count(text, r"[!?]") / chars,
        "marks": _count(text, r"[#&%*$@^~=<>{}\[\]\\_+]") / chars,
        "bars": _count(text, r"\|") / chars,
        "stops": _count(text, r"[.,;:]") / chars,
        "digits": _count(text, r"[0-9]") / chars,
        "lines": _count(text, r"\n") / per_word,
        "repeats": _count(text, r"(?<!\S)(\S++)\s++(?=\1(?!\S))") / per_word,
    }


NAMES = ("log_chars", "chars_per_word", "upper", "bangs", "marks", "bars", "stops", "digits", "lines", "repeats")


@dataclass(frozen=True)
class RuleModel:
    """Weights of conjunctive rules; ``constant`` replaces them when the labels had one class or none."""

    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    bias: float
    constant: float | None = None

    def score(self, at=F.col) -> Column:
        """Probability of label 1; ``at`` gives the statistic of a name, by default a column."""
        if self.constant is not None:
            return F.lit(float(self.constant))
        terms = [F.when(rule_column(rule, at), F.lit(w)).otherwise(0.0) for rule, w in self.rules]
        return 1.0 / (1.0 + F.exp(-reduce(add, terms, F.lit(self.bias))))


def rule_column(rule: tuple[Condition, ...], at=F.col) -> Column:
    return reduce(and_, (at(n) <= F.lit(t) if at_most else at(n) > F.lit(t) for n, at_most, t in rule))


def _paths(node, so_far: tuple[Condition, ...] = ()):
    """Conditions on the way to every node below a root."""
    if so_far:
        yield so_far
    if hasattr(node, "split") and node.subtreeDepth() > 0:
        split = node.split()
        name, threshold = NAMES[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), (*so_far, (name, True, threshold)))
        yield from _paths(node.rightChild(), (*so_far, (name, False, threshold)))


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 11) -> RuleModel:
    """Fit rules on columns ``NAMES`` and ``label`` (0 or 1)."""
    counts = {int(r.label): r["count"] for r in train.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return RuleModel((), 0.0, (counts.get(1, 0) + 0.5) / (total + 1))
    rows = train.withColumn("features", array_to_vector(F.array(*NAMES)))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=max(1, total // 1000), featureSubsetStrategy="0.5",
        subsamplingRate=0.7, seed=seed).fit(rows)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in _paths(tree._java_obj.rootNode())))
    if not rules:
        return RuleModel((), 0.0, counts[1] / total)
    held = cut(train.select(F.col("label"), array_to_vector(F.array(*(rule_column(r).cast("double") for r in rules))).alias("features")))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(held)
    weights = lasso.coefficients.toArray()
    return RuleModel(tuple((r, float(w)) for r, w in zip(rules, weights) if w), float(lasso.intercept))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is a multiple of 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def text_statistics(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *(c.alias(n) for n, c in statistics(text).items()))


def train_model(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> RuleModel:
    """A model from the labelled rows that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.min("quality").cast("double").alias("label"))
    labelled = cut(stats.where(~held_out(F.col("doc_id"))).join(known, F.col("doc_id") == F.col("_id")))
    share = min(1.0, train_rows / max(1, labelled.count()))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return fit(chosen.select("label", *NAMES))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= threshold, else 0).

    A null text counts as empty and gets a score like any other; a null doc_id is held out; repeated rows score alike;
    labels other than 0 and 1 or without a document are ignored, a document with several counts as its lowest. Without
    labels of both classes the score is their share (0.5 without any). Other columns are ignored; an empty table gives
    no rows.
    """
    stats = cut(text_statistics(docs))
    model = train_model(stats, labels, train_rows)
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all their columns unchanged; no shuffle of texts.

    The statistics are bound once per row: as plain columns under a filter the optimizer would put each of them into
    every rule that reads it, and count the same text again and again.
    """
    model = train_model(cut(text_statistics(docs)), labels, train_rows)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    measured = F.struct(*(c.alias(n) for n, c in statistics(text).items()))
    return docs.where(let(measured, lambda s: model.score(lambda name: s[name])) >= threshold)
