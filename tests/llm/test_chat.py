import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridpulse.llm import chat
from tests.llm import brute

ROWS = [
    (1, 0, "system", "be <s>[kind] \\e \\\\l"), (1, 1, "user", "</s>[INST] ok [/INST] [TURN] "), (1, 2, "user", None), (1, 3, "assistant", " </s>"),
    (1, 4, "assistant", "yes 😀"), (2, 0, None, "no role"), (2, 1, "assistant", ""), (3, 5, "odd] role", "x"), (3, 5, "odd] role", "x"),
    (None, 0, "user", "lost"), (4, None, "user", None), (5, 0, "assistant", "long " * 50_000), (5, 1, "user", "t" * 10),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        out.append((conv, len(turns), brute.sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), brute.sha(loss)))
    return out


def test_reads_back(spark):
    formatted = chat.format_chats(spark.createDataFrame(ROWS, SCHEMA).withColumn("_turns", F.lit(1)).withColumn("formatted", F.lit("x")))
    got = [tuple(r)[:5] for r in chat.digests(formatted).collect()]
    assert brute.by_none(got) == brute.by_none(expected(ROWS))
    plan = chat.digests(formatted)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_same_roles_share_a_block_and_the_mask_covers_answers(spark):
    formatted = chat.format_chats(spark.createDataFrame(ROWS, SCHEMA)).collect()
    one = {r.conv_id: r for r in formatted}[1]
    assert one.formatted.count("<s>[") == 3 and one.formatted.count(" [TURN] ") == 2
    for r in formatted:
        at, covered = 0, []
        for run in r.loss_runs:
            at += run.skip
            covered.append(r.formatted[at: at + run.take])
            at += run.take + run["pass"]
        assert at == len(r.formatted)
        plain = "".join(covered)
        for text, escaped in reversed(chat.ESCAPES):
            plain = plain.replace(escaped, text)
        want = sorted((t is not None, t or 0, role or "", text or "") for c, t, role, text in ROWS if c == r.conv_id)
        assert plain == "".join(text for *_, role, text in want if role == "assistant")


def test_loss_comes_from_the_mask(spark):
    """The mask is part of the plan; a shifted one changes the digests, one of another length is an error."""
    formatted = chat.format_chats(spark.createDataFrame(ROWS, SCHEMA))
    assert "loss_runs" in chat.digests(formatted)._jdf.queryExecution().optimizedPlan().toString()
    moved = lambda skip, last: formatted.withColumn("loss_runs", F.transform("loss_runs", lambda r: F.struct(
        (r["skip"] + skip).alias("skip"), r["take"].alias("take"), (r["pass"] + last).alias("pass"))))
    right = {r.conv_id: r.loss_sha256 for r in chat.digests(formatted).collect()}
    wrong = {r.conv_id: r.loss_sha256 for r in chat.digests(moved(-1, 1)).collect()}
    assert {c for c in right if right[c] != wrong[c]} == {1, 5}  # the others have no text under the mask
    with pytest.raises(PySparkException, match="does not fit"):
        chat.digests(moved(1, 0)).collect()


def test_empty(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0
