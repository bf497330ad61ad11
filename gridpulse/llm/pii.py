"""Personal data: candidate spans, boosted trees over format and context, redaction. Spark expressions only.

1. Base spans: strict patterns with validity checks.
2. Generators with high recall propose further spans (numbers of any grouping, written-out mail addresses). A candidate
   carries a few small integers: format and context features, without the marks that define the base pattern.
3. Candidates are counted by (feature values, overlapped by a base span or not). That table has at most one row per
   combination of feature values, whatever the corpus, and is all that boosting sees: every candidate takes part.
4. Trees of depth two are boosted per kind on one half of the documents, with base spans as the positive rows. The other
   rows are unlabelled, not negative: personal data written without the mark is among them. What share of it is marked is
   read off rows with evidence of their own, a cue word of the kind in front and a format that marked ones have. On the
   other half a threshold is calibrated: the lowest score down to which every level has at least ``precision`` of that share.
5. The trees become column expressions; accepted candidates that no base span overlaps are added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gridpulse.functions.columns import let
from gridpulse.sources.scratch import cut

KINDS = ("email", "ip", "card", "phone")
ROUNDS, RATE, PRECISION, LEAST_SUPPORT = 12, 0.5, 0.99, 20
# a kind that is marked more rarely than this where cue words announce it is not trusted to be it
LEAST_MARKED = 0.2

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# A match can start where a run of its first class starts, or where the last match ended; so no start is tried twice.
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# What separates runs of digits with single blanks or hyphens inside.
_CARD_GAP = r"[^0-9]{2,}|[^0-9 -]|\A[ -]|[ -]\z"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_NUMBER = r"[+(]?[0-9][0-9 ().\-/]{5,}[0-9]"
_WRITTEN = (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++ ?(?:@|\(at\)|\[at\]|\{{at\}}) ?{_LABEL}++"
            rf"(?: ?(?:\.|\(dot\)|\[dot\]|\{{dot\}}) ?{_LABEL}++)++")
_STEP = 256
FEATURES = ("family", "length", "parts", "dots", "paren", "luhn", "octets", "before", "cue")
FORMAT = FEATURES[:7]
CUES = {"phone": 1, "card": 2, "ip": 3, "email": 4}


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _running(numbers: Column) -> Column:
    """Inclusive prefix sums in blocks, so that a text with very many matches stays cheap."""
    block = lambda i: F.floor(i / _STEP).cast("int")

    def summed(lengths: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), block(F.size(lengths) - 1)),
                             lambda b: _sum(F.slice(lengths, b * _STEP + 1, F.lit(_STEP))))
        offsets = F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return let(offsets, lambda before: F.transform(lengths, lambda _, i: F.get(before, block(i)) + _sum(
            F.slice(lengths, block(i) * _STEP + 1, i % _STEP + 1))))

    return let(numbers, summed)


def _located(pairs: Column) -> Column:
    """Spans with their surroundings, from pairs (gap, value) in text order; a null value is no match."""
    length = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["value"]), F.lit(0))

    def spans(p: Column) -> Column:
        ends = _running(F.transform(p, length))
        at = let(ends, lambda e: F.transform(p, lambda x, i: F.struct(
            (F.get(e, i) - F.length(x["value"])).alias("start"), F.get(e, i).alias("end"), x["value"].alias("value"),
            F.right(x["gap"], F.lit(12)).alias("before"))))
        return F.filter(at, lambda x: x["value"].isNotNull())

    return let(pairs, spans)


def _pair(gap: Column, value: Column) -> Column:
    return F.struct(F.coalesce(gap, F.lit("")).alias("gap"), value.alias("value"))


def find_all(text: Column, pattern: str) -> Column:
    """Non-overlapping matches, leftmost first: array of (start, end, value, before); code points, end exclusive."""
    return _located(F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), _pair))


def find_between(text: Column, gap: str) -> Column:
    """The same for what lies between the matches of ``gap``."""
    gaps = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(gap), F.lit(0)))
    return _located(F.zip_with(gaps, F.split(text, gap, -1), _pair))


def _octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: p.rlike(r"\A0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\z"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def base_spans(text: Column) -> dict[str, Column]:
    """Valid strict matches of each kind; texts without a tell-tale character are not searched."""
    some = lambda test, spans: F.when(test, spans).otherwise(F.array().cast(
        "array<struct<start:int,end:int,value:string,before:string>>"))
    digit = text.rlike("[0-9]")
    card = F.filter(find_between(text, _CARD_GAP), lambda s: (F.length(s["value"]) >= 16) & let(
        _digits(s["value"]), lambda d: F.length(d).between(16, 19) & F.call_function("luhn_check", d)))
    phone = F.filter(find_all(text, _PHONE), lambda s: F.length(_digits(s["value"])).between(8, 15))
    return {
        "email": some(text.contains("@"), find_all(text, _EMAIL)),
        "ip": some(digit & text.contains("."), F.filter(find_all(text, _IP), lambda s: _octets(s["value"]))),
        "card": some(digit, card),
        "phone": some(text.contains("+"), phone),
    }


def _bucket(value: Column, bounds: tuple[int, ...]) -> Column:
    """How many bounds a value reaches."""
    out = F.lit(0)
    for b in bounds:
        out = out + (value >= b).cast("int")
    return out


def _unmarked(value: Column, family: int) -> Column:
    """A candidate as it reads without, or with, the mark of the strict pattern: both give the same text."""
    if family == 0:
        return F.regexp_replace(value, r"\A[+(]+", "")
    at = F.regexp_replace(value, r" ?(?:@|\(at\)|\[at\]|\{at\}) ?", "@")
    return F.regexp_replace(at, r" ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?", ".")


def _candidate(span: Column, family: int) -> Column:
    value, before = _unmarked(span["value"], family), span["before"]
    digits = _digits(value)
    last = F.right(before, F.lit(1))
    low = F.lower(before)
    mail = family == 1
    cue = F.when(low.rlike("tel|phone|call|mob|fax"), 1).when(low.rlike("card|visa|pay"), 2).when(
        low.rlike("ip|host|addr"), 3).when(low.rlike("mail|contact"), 4).otherwise(0)
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), F.lit(family).alias("family"),
        (_bucket(F.length(value), (8, 16, 32)) if mail else _bucket(F.length(digits), (8, 10, 12, 14, 16, 20))).alias("length"),
        _bucket(F.size(F.split(value, "[^A-Za-z0-9]+" if mail else "[^0-9]+", -1)), (2, 3, 4, 5, 6)).alias("parts"),
        _bucket(F.length(value) - F.length(F.replace(value, F.lit("."), F.lit(""))), (1, 3, 4)).alias("dots"),
        F.substring(value, 2, 64).contains("(").cast("int").alias("paren"),
        (F.length(digits).between(12, 19) & F.coalesce(F.call_function("luhn_check", digits), F.lit(False))).cast("int").alias("luhn"),
        (value.rlike(r"\A[0-9]+(\.[0-9]+){3}\z") & _octets(value)).cast("int").alias("octets"),
        F.when(last.rlike(r"\A\s?\z"), 0).when(last.rlike("[A-Za-z]"), 1).otherwise(2).alias("before"), cue.alias("cue"))


def candidates(text: Column) -> Column:
    numbers = F.when(text.rlike("[0-9]"), F.transform(find_all(text, _NUMBER), lambda s: _candidate(s, 0)))
    mails = F.when(text.rlike(r"@|[(\[{]at[)\]}]"), F.transform(find_all(text, _WRITTEN), lambda s: _candidate(s, 1)))
    none = F.array().cast("array<struct<start:int,end:int," + ",".join(f"{f}:int" for f in FEATURES) + ">>")
    return F.concat(F.coalesce(numbers, none), F.coalesce(mails, none))


def _with_spans(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep``, one array of base spans per kind, and the candidates with the kind of base span they meet."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(*keep, *(F.transform(c, lambda s: F.struct(s["start"], s["end"])).alias(f"_{k}")
                                 for k, c in base_spans(text).items()), candidates(text).alias("_candidates"))
    meets = lambda c, k: F.exists(f"_{k}", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"]))
    known = lambda c: F.coalesce(*(F.when(meets(c, k), k) for k in KINDS), F.lit(""))
    return found.withColumn("_candidates", F.transform("_candidates", lambda c: F.struct(c.alias("c"), known(c).alias("base"))))


@dataclass(frozen=True)
class Model:
    """Boosted trees of one kind: (start value, trees), and the calibrated threshold (above 1: accept nothing)."""

    start: float
    trees: tuple
    threshold: float

    def score(self, c: Column) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + _tree_column(tree, c)
        return 1.0 / (1.0 + F.exp(-total))


def _tree_column(tree, c: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, bound, low, high = tree
    return F.when(c[feature] <= bound, _tree_column(low, c)).otherwise(_tree_column(high, c))


def _tree_value(tree, row) -> float:
    while not isinstance(tree, float):
        feature, bound, low, high = tree
        tree = low if row[feature] <= bound else high
    return tree


def _grow(rows, depth: int):
    """A regression tree by Newton gain; ``rows`` are (features, gradient, curvature)."""
    gain = lambda part: sum(r[1] for r in part) ** 2 / (sum(r[2] for r in part) + 1.0)
    best = None
    if depth:
        for feature in FEATURES:
            for bound in sorted({r[0][feature] for r in rows})[:-1]:
                sides = [r for r in rows if r[0][feature] <= bound], [r for r in rows if r[0][feature] > bound]
                better = gain(sides[0]) + gain(sides[1]) - gain(rows)
                if better > 1e-6 and (best is None or better > best[0]):
                    best = better, feature, bound, *sides
    if best is None:
        return RATE * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + 1.0)
    return best[1], best[2], _grow(best[3], depth - 1), _grow(best[4], depth - 1)


def marked_share(table: list[dict], kind: str) -> float:
    """Share of a kind's true spans that are base spans, among rows that a cue word of the kind announces.

    Only rows of a format that base spans of the kind have on the other half count. 1 where such rows are too few, or
    too seldom marked to be what the cue says.
    """
    formats = {tuple(r[f] for f in FORMAT) for r in table if r["fold"] == 0 and r[kind]}
    told = [r for r in table if r["fold"] == 1 and r["cue"] == CUES[kind] and tuple(r[f] for f in FORMAT) in formats]
    hits = sum(r[kind] for r in told)
    n = sum(r["n"] - sum(r[k] for k in KINDS if k != kind) for r in told)
    return hits / n if n >= LEAST_SUPPORT and hits >= LEAST_MARKED * n else 1.0


def boost(table: list[dict], precision: float = PRECISION, marked: float = 1.0) -> Model:
    """Fit one kind on rows of feature values with ``fold``, ``n`` candidates and ``hits`` among them.

    ``marked`` is the share of true spans that are hits. A level of scores is accepted when its share of hits is at least
    ``precision`` of that, but for two standard errors, and all higher levels are; levels of few rows count together.
    """
    train = [r for r in table if r["fold"] == 0]
    n, hits = sum(r["n"] for r in train), sum(r["hits"] for r in train)
    if not hits:
        return Model(0.0, (), 2.0)
    start, trees = math.log((hits + 0.5) / (n - hits + 0.5)), []
    margin = [start] * len(train)
    for _ in range(ROUNDS):
        rows = []
        for r, m in zip(train, margin):
            p = 1 / (1 + math.exp(-m))
            rows.append((r, r["hits"] - r["n"] * p, r["n"] * p * (1 - p)))
        trees.append(_grow(rows, 2))
        margin = [m + _tree_value(trees[-1], r) for r, m in zip(train, margin)]
    total = lambda r: start + sum(_tree_value(t, r) for t in trees)
    threshold, seen, right = 2.0, 0, 0
    held = sorted((r for r in table if r["fold"] == 1), key=total, reverse=True)
    for k, r in enumerate(held):
        seen, right = seen + r["n"], right + r["hits"]
        last = k + 1 == len(held) or total(held[k + 1]) < total(r)
        if last and seen >= LEAST_SUPPORT:
            if right + 2 * math.sqrt(seen * marked * (1 - marked)) < precision * marked * seen:
                break
            threshold, seen, right = 1 / (1 + math.exp(-total(r))) - 1e-9, 0, 0
    return Model(start, tuple(trees), threshold)


def fit(spans: DataFrame, precision: float = PRECISION) -> dict[str, Model]:
    """A model per kind from the stored candidates of all documents."""
    each = spans.select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("fold"), F.explode("_candidates").alias("x"))
    counted = each.groupBy("fold", *(F.col(f"x.c.{f}").alias(f) for f in FEATURES)).agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("x.base") == k).alias(k) for k in KINDS))
    rows = [r.asDict() for r in counted.orderBy("fold", *FEATURES).collect()]
    family = lambda k: 1 if k == "email" else 0
    of = lambda k: [r | {"hits": r[k]} for r in rows if r["family"] == family(k)]
    return {k: boost(of(k), precision, marked_share(of(k), k)) for k in KINDS}


def _added(models: dict[str, Model]) -> dict[str, Column]:
    """Accepted candidates of each kind that no base span meets; of several kinds the likeliest."""
    def accepted(k: str):
        rivals = [o for o in KINDS if o != k and models[o].threshold <= 1]
        score = lambda c, kind: F.when(c["family"] == (1 if kind == "email" else 0), models[kind].score(c)).otherwise(0.0)

        def test(x: Column) -> Column:
            good = (x["base"] == "") & (score(x["c"], k) >= models[k].threshold)
            for o in rivals:
                good = good & (score(x["c"], k) > score(x["c"], o))
            return good

        return F.transform(F.filter("_candidates", test), lambda x: F.struct(x["c"]["start"], x["c"]["end"]))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return {k: accepted(k) if models[k].threshold <= 1 else none for k in KINDS}


def _told(kinds_and_spans) -> Column:
    def named(k: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(k), s["start"], s["end"]))

    return F.array_join(F.concat(*(named(k, spans) for k, spans in kinds_and_spans)), ",")


def _all_spans(models: dict[str, Model]) -> dict[str, Column]:
    return {k: F.array_sort(F.concat(F.col(f"_{k}"), added)) for k, added in _added(models).items()}


def find_pii(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base, spans.

    ``base`` and ``spans`` are texts ``kind:start:end`` joined by commas, by kind and then start; positions are code
    points, ends exclusive; ``spans`` has the base spans and those the model adds. A null text is empty; repeated rows
    and null ids keep their rows; other columns are ignored. Without base spans of a kind its model adds nothing.
    """
    stored = cut(_with_spans(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), "doc_id"))
    models = fit(stored, precision)
    return stored.select(
        "doc_id", *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS),
        _told((k, F.col(f"_{k}")) for k in KINDS).alias("base"), _told(_all_spans(models).items()).alias("spans"))


def redact(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets, such as ``[EMAIL]``.

    Overlapping spans go as one, under the kind that starts first. A column ``n_chars`` follows the new text; a null
    text stays null; all other columns stay. The text is only rewritten where a span was found.
    """
    names = docs.columns
    models = fit(cut(_with_spans(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), "doc_id")), precision)
    row = docs.select(F.struct(*(F.col(f"`{n}`") for n in names)).alias("_row"), F.col("text"))
    found = _with_spans(row, "_row")

    def tags(k: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{k.upper()}]").alias("tag")))

    tagged = F.array_sort(F.concat(*(tags(k, spans) for k, spans in _all_spans(models).items())))
    text = F.col("_row.text").cast("string")

    def rewritten(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
        step = lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["parts"]).otherwise(F.concat(a["parts"], F.array(
                F.substring(text, a["at"] + 1, s["start"] - a["at"]), s["tag"]))).alias("parts"))
        return F.aggregate(spans, start, step, lambda a: F.concat(
            F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))))

    clean = F.when(F.size("_tags") > 0, rewritten(F.col("_tags"))).otherwise(text)
    kept = {n: clean if n == "text" else F.col("_row")[n] for n in names}
    out = found.select("_row", tagged.alias("_tags")).select(*(c.alias(n) for n, c in kept.items()))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in names else out
