"""Operator 6 turn by turn: the role machine against a plain loop, long and odd conversations."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quireflow.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def _rows(turns, conv):
    return sorted((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv)


def _plain(turns, conv, template):
    """The columns of ``digests`` for one conversation, by a loop over its turns."""
    rows, state = _rows(turns, conv), template.start
    for *_, role, _ in rows:
        state = template.moves.get((state, role), "")
    spoken = "".join(f"{role}\n{text}\n" for *_, role, text in rows)
    loss = "".join(text for *_, role, text in rows if role in template.loss_roles)
    return (len(rows), hashlib.sha256(spoken.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            state in template.accept)


def _random_turns(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "other\n"]
    turns = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(roles) if rng.random() < 0.15 else ("user", "assistant")[turn % 2]
            row = (conv, None if rng.random() < 0.03 else turn, role, rng.choice(["", None, "a\\</s>", "é[INST]", "x" * 70]))
            turns += [row] * rng.choice([1, 1, 1, 1, 2, 7])
    rng.shuffle(turns)
    return turns


@pytest.mark.parametrize("template", [
    chat.Template(), chat.Template(moves={("start", "user"): "start", ("start", "assistant"): "odd", ("odd", "assistant"): "start",
                                          ("odd", "user"): "odd"}, accept=("start",))])
def test_digests_against_a_loop(spark, template):
    turns = _random_turns(3)
    out = {r.conv_id: r for r in chat.digests(spark.createDataFrame(turns, SCHEMA), template).collect()}
    assert set(out) == {t[0] for t in turns}
    for conv, r in out.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) == _plain(turns, conv, template), conv
    assert len({r.valid for r in out.values()}) == 2


def test_blocks_of_any_size_give_the_same_verdicts(spark):
    turns = _random_turns(8)
    df = spark.createDataFrame(turns, SCHEMA)
    found = [{r.conv_id: (r.n_turns, r.valid) for r in chat.judge(df, block=size).collect()} for size in (1, 3, 4096)]
    assert found[0] == found[1] == found[2]


def test_repeats_move_the_machine_each_time(spark):
    template = chat.Template(moves={("start", "flip"): "up", ("up", "flip"): "start"}, accept=("up",))
    df = spark.createDataFrame([(c, 0, "flip", "t") for c in (1, 2, 3, 100, 101) for _ in range(c)], SCHEMA)
    assert {r.conv_id: r.valid for r in chat.judge(df, template).collect()} == {1: True, 2: False, 3: True, 100: False, 101: True}


def test_a_conversation_of_200000_turns(spark):
    n = 200_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    df = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
                               F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    row = chat.digests(df).first()
    spoken = "".join(f"{('user', 'assistant')[i % 2]}\nt{i}\n" for i in range(n))
    loss = "".join(f"t{i}" for i in range(1, n, 2))
    assert (row.n_turns, row.valid, row.loss_chars) == (n, True, len(loss))
    assert row.turns_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    broken = df.withColumn("role", F.when(F.col("turn") == 150_001, "user").otherwise(F.col("role")))
    assert not chat.judge(broken).first().valid


def test_turns_are_formatted_without_an_exchange(spark):
    df = spark.createDataFrame([(1, 0, "user", "q")], SCHEMA)
    plan = chat.format_turns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.judge(none).count() == 0 and chat.digests(none).count() == 0 and chat.format_turns(none).count() == 0
