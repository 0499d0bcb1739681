import hashlib
import random

import pytest
from pyspark.sql import functions as F

from orderloom.llm import chat
from orderloom.llm.scratch import settle, stored

COLUMNS = "conv_id long, turn long, role string, text string, part long, loss_starts string"
PIECES = [*(c.decode() for c in chat.CONTROLS), "\\", "<", "[", "/", " ", "\n", "é", "\U0001f600", "INST]", "s>", "", "x"]


@pytest.fixture(autouse=True)
def _settled(spark):
    settle(spark)


def _expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))
    found = {}
    for conv, _, role, text in order:
        found.setdefault(conv, []).append((role or "", text or ""))
    return found


def _checked(spark, rows, partitions=None, loss_roles=chat.LOSS_ROLES):
    df = spark.createDataFrame([(*r, 5, "taken") for r in rows], COLUMNS)
    parts = stored(chat.format_chats(df, loss_roles), "chats")
    expected = _expected(rows)
    turns = {}
    for r in sorted(chat.parse_turns(parts).collect(), key=lambda r: (r["part"], r["place"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert turns == expected
    texts = {}
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        whole = texts.setdefault(r["conv_id"], ["", []])
        whole[0] += r["text"]
        whole[1] += [r["text"].encode()[a:b].decode() for a, b in zip(r["loss_starts"], r["loss_ends"])]
    found = {r["conv_id"]: r for r in chat.digests(parts).collect()}
    assert set(found) == set(expected)
    for conv, given in expected.items():
        r, loss = found[conv], [t for role, t in given if role in loss_roles]
        assert r["n_turns"] == len(given)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in given).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len("".join(loss)), hashlib.sha256("".join(loss).encode()).hexdigest())
        assert r["formatted_chars"] == len(texts[conv][0])
        assert len(texts[conv][1]) == len(loss) and not any(c.decode() in t for t in texts[conv][1] for c in chat.CONTROLS)
        assert sum(texts[conv][0].count(c.decode()) for c in chat.CONTROLS) == sum(2 + (role not in chat.OPENS) for role, _ in given)
    return parts


def test_any_text_comes_back(spark):
    rng = random.Random(3)
    text = lambda: rng.choice([None, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))])
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 1, 2, 9]), rng.choice(["user", "assistant", "system", None, "", "tool [ROLE]", "\\"]), text()) for _ in range(400)]
    _checked(spark, rows + rows[:20])


def test_other_roles_can_be_trained_on(spark):
    _checked(spark, [(1, 0, "tool", "a<s>"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], loss_roles=("tool", "user"))


def test_long_texts_stand_alone_and_large_conversations_are_dealt(spark):
    rows = [(1, i, "user", "u" * 20) for i in range(3000)] + [(1, 3000, "assistant", "\\<s>" * 400_000), (2, 0, "user", "q")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart, as large ones do
    try:
        parts = _checked(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts.where("conv_id = 1").count() > 10
    tasks = {r["part"] >> 33 for r in parts.where("conv_id = 1").collect()}
    assert len(tasks) > 1, "one conversation is formatted by several tasks"


def test_empty_table(spark):
    _checked(spark, [])


def test_other_text_is_refused(spark):
    bad = spark.createDataFrame([(1, 0, "[INST] a </s>", [], [])], "conv_id long, part long, text string, loss_starts array<long>, loss_ends array<long>")
    with pytest.raises(Exception, match="not in the chat template"):
        chat.digests(bad).collect()


def test_template_as_written(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "a\\"), (1, 3, "tool", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    text = "".join(r["text"] for r in chat.format_chats(df).orderBy("part").collect())
    assert text == "<<SYS>> s <</SYS>>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]<s> a\\\\ </s>[ROLE] tool [/ROLE] t [END]"
    assert chat.format_chats(df.where(F.col("turn") < 0)).count() == 0
