import math

import pytest
from pyspark.sql import functions as F

from gridpulse.llm import pii
from tests.llm import brute

ODD = ["a@b.c_d@e.f x@y é😀 4111-1111-1111-1111 4111 1111 1111 1111", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.0255 1.1.1.1.",
       "a@" * 500 + "b.c", "1 " * 5000, "1." * 5000, "9" * 9000, "+1-" * 900, "x@y.zz " * 700, " 4111111111111111", "4111111111111111-",
       "-4111111111111111 \n", "@@a@b..c@d.e+1234567 89", "+12345678+12345678..", "a%b@c-.d-.", "4111111111111111  4111111111111111",
       "+1 (((.)) 2345678-- x", "", None, "4111 1111-1111 1111 5", "a@b.c,d@e.f;+1 234 567 8901 tel", "٣@b.c +٣12345678 1.1.1.٣"]


@pytest.fixture(scope="module")
def found(spark, documents):
    odd = spark.createDataFrame([(-1000 - i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = documents.select("doc_id", "text", "rep").unionByName(odd.withColumn("rep", F.lit(0)))
    return docs.select("doc_id", "text").collect(), pii.find_pii(docs)


def test_base_spans_equal_brute_force(found):
    rows, df = found
    got = [(r.doc_id, r.base, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in df.collect()]
    want = []
    for i, text in rows:
        spans = brute.personal(text)
        want.append((i, ",".join(spans), *(sum(s.startswith(k) for s in spans) for k in pii.KINDS)))
    assert brute.by_none(got) == brute.by_none(want)


def test_base_spans_stay(found):
    for r in found[1].collect():
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_plan_has_no_python(found):
    plan = found[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_model_adds_what_looks_like_base_spans(spark):
    texts = [(i, f"call +1 (377) 555-{1000 + i} now and again") for i in range(200)]
    texts += [(i, f"build number {i}00200{i} passed all of it") for i in range(200, 400)]
    texts += [(1001, "call 1 (377) 555-0271 now"), (1002, "nothing to see in 2024")]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got[1001].base == "" and got[1001].spans.startswith("phone:5:") and got[1002].spans == ""
    assert all(got[i].spans == "" for i in range(200, 400))


def phones_of_both_kinds():
    """As many phones without the mark as with it, some with no cue, and numbers that look alike."""
    lead = ("call {} now", "tel {}", "or {} then")
    rows = [(i, lead[i % 3].format(f"+1 (377) 555-{1000 + i}")) for i in range(400)]
    rows += [(i, lead[i % 3].format(f"1 (377) 555-{1000 + i}")) for i in range(400, 800)]
    rows += [(i, f"build {i}00200{i} of 2024-01-0{i % 9 + 1} 10") for i in range(800, 1200)]
    rows += [(i, f"mail to bob{i}@ex{i}.org") for i in range(1200, 1400)]
    return rows + [(i, f"contact bob{i} (at) ex{i} (dot) org") for i in range(1400, 1600)] + [(1600, "they met @ noon"), (1601, None)]


def test_unmarked_spans_are_added_and_look_alikes_are_not(spark):
    docs = spark.createDataFrame(phones_of_both_kinds(), "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    assert sum(got[i].startswith("phone:") for i in range(400, 800)) > 380
    assert sum(got[i].startswith("email:") for i in range(1400, 1600)) > 190
    assert all(got[i] == "" for i in (*range(800, 1200), 1600, 1601))


def test_added_spans_equal_brute_force(spark):
    """Candidates, features and scores once more in Python, with the fitted trees."""
    rows = phones_of_both_kinds()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    models = pii.fit(pii.cut(pii._with_spans(docs, "doc_id")))
    got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    for i, text in rows:
        base = brute.personal(text)
        taken = [tuple(map(int, s.split(":")[1:])) for s in base]
        want = list(base)
        for start, end, features in brute.pii_candidates(text or ""):
            if any(s < end and e > start for s, e in taken):
                continue
            scores = {}
            for kind, m in models.items():
                if (kind == "email") == bool(features["family"]) and m.threshold <= 1:
                    margin = m.start + sum(pii._tree_value(t, features) for t in m.trees)
                    scores[kind] = 1 / (1 + math.exp(-margin))
            top = max(scores, key=scores.get, default=None)
            if top and scores[top] >= models[top].threshold:
                want.append(f"{top}:{start}:{end}")
        order = lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1]))
        assert got[i] == ",".join(sorted(want, key=order)), text


def test_share_of_marked_spans():
    row = dict.fromkeys((*pii.FEATURES, *pii.KINDS), 0) | {"length": 3}
    table = [row | {"fold": 0, "n": 50, "phone": 50}, row | {"fold": 1, "cue": 1, "n": 100, "phone": 60, "card": 20}]
    assert pii.marked_share(table, "phone") == 0.75
    assert pii.marked_share(table, "card") == 1.0  # no format of marked cards
    assert pii.marked_share([table[0], table[1] | {"phone": 5}], "phone") == 1.0
    rows = [row | {"fold": f, "parts": p, "n": 100, "hits": 50 * p} for f in (0, 1) for p in (0, 1)]
    assert pii.boost(rows).threshold > 1 and pii.boost(rows, marked=0.5).threshold < 1


def test_boosting_calibrates_or_stays_silent():
    row = dict.fromkeys(pii.FEATURES, 0)
    clear = [row | {"fold": f, "parts": p, "n": 100, "hits": 100 * p} for f in (0, 1) for p in (0, 1)]
    assert 0.5 < pii.boost(clear).threshold < 1
    assert pii.boost([r | {"hits": 50} for r in clear]).threshold > 1
    assert pii.boost([r | {"hits": 0} for r in clear]).threshold > 1


def test_redaction(spark, documents, empty_documents):
    got = {r.doc_id: r for r in pii.redact(documents).collect()}
    assert got[-10].text == "mail [EMAIL] or [PHONE], [CARD] at [IP]" and got[-10].n_chars == len(got[-10].text)
    assert got[-1].text is None and got[-10].rep == 4
    assert pii.redact(documents).columns == documents.columns
    assert pii.redact(empty_documents).count() == 0 and pii.find_pii(empty_documents).count() == 0
    again = pii.find_pii(pii.redact(documents))
    assert again.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
