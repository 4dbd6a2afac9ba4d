"""Conversations stored per turn, in one block and in several."""

import pytest
from pyspark.sql import functions as F

from chatlake.functions.messages import is_reply
from chatlake.operators import turns as R


@pytest.fixture(scope="module")
def talk(spark):
    """Conversations of 1, 2, 7 and 40 turns; user and assistant alternate."""
    rows = [
        (conv, turn, "user" if turn % 2 == 0 else "assistant", f"c{conv}t{turn}")
        for conv, length in enumerate([1, 2, 7, 40])
        for turn in range(length)
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).cache()


def said(conv, turn):
    role = "user" if turn % 2 == 0 else "assistant"
    return f"<|im_start|>{role}\nc{conv}t{turn}<|im_end|>\n"


@pytest.mark.parametrize("block", [2, 3, 16, 512])
def test_training_rows_do_not_depend_on_blocks(talk, block):
    blocks = R.rendered_blocks(talk, is_reply(F.col("role")), block_turns=block)
    got = {(r.conv_id, r.turn_index): r for r in R.training_rows(blocks).collect()}
    want = {(c, t) for c, n in enumerate([1, 2, 7, 40]) for t in range(1, n, 2)}
    assert set(got) == want
    for (conv, turn), row in got.items():
        assert row.prompt == "".join(said(conv, t) for t in range(turn))
        assert row.completion == said(conv, turn)
        assert row.text == row.prompt + row.completion


@pytest.mark.parametrize("block", [2, 16, 512])
def test_evaluation_prompts_do_not_depend_on_blocks(talk, block):
    blocks = R.rendered_blocks(talk, F.lit(False), block_turns=block)
    got = {r.conv_id: (r.reply_turn, r.prompt) for r in R.evaluation_prompts(blocks).collect()}
    assert sorted(got) == [1, 2, 3]
    for conv, last in ((1, 1), (2, 5), (3, 39)):
        prompt = "".join(said(conv, t) for t in range(last)) + "<|im_start|>assistant\n"
        assert got[conv] == (last, prompt)


def test_blocks_without_turns(spark):
    turns = spark.createDataFrame(
        [(0, 0, "user", "a"), (0, 9, "assistant", "b")], "conv_id long, turn long, role string, text string"
    )
    row = R.training_rows(R.rendered_blocks(turns, is_reply(F.col("role")), block_turns=2)).first()
    assert row.turn_index == 9 and row.prompt == "<|im_start|>user\na<|im_end|>\n"


@pytest.mark.parametrize("block", [2, 512])
def test_invalid_conversations_give_no_rows(talk, block):
    spoiled = talk.withColumn("role", F.when(F.expr("conv_id = 3 and turn = 1"), "narrator").otherwise(F.col("role")))
    made = R.training_rows(R.rendered_blocks(spoiled, is_reply(F.col("role")), block_turns=block))
    assert {r.conv_id for r in made.collect()} == {1, 2}
    assert [tuple(r) for r in R.invalid_conversations(spoiled).collect()] == [
        (3, "Message 1 has unsupported role: narrator")
    ]


def test_assemble_orders_turns(talk):
    rows = {r.conv_id: r.messages for r in R.assemble(talk).collect()}
    assert [m.content for m in rows[3]] == [f"c3t{t}" for t in range(40)]
    assert rows[0][0].role == "user"


@pytest.mark.parametrize("block", [2, 512])
def test_splits_follow_conversations(talk, block):
    rows = R.split_training_rows(talk, is_reply(F.col("role")), block_turns=block).collect()
    assert len(rows) == 1 + 3 + 20
    assert all(r.conv_id == r.example_index for r in rows)
    # 4 conversations: indexes 0-3 are at 0, 0.25, 0.5 and 0.75
    assert {r.split for r in rows} == {"train"}


@pytest.mark.parametrize("partitions", ["1", "8", "23"])
def test_results_do_not_depend_on_partitions(spark, talk, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = R.split_training_rows(talk, is_reply(F.col("role"))).select("example_index", "turn_index", "text", "split")
        got = sorted(tuple(r) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == 1 + 3 + 20 and got[0][:2] == (1, 1)


def test_training_plan_stays_in_the_jvm(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    made = R.training_rows(R.rendered_blocks(turns, is_reply(F.col("role"))))
    text = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "SinglePartition" not in text
    assert text.count("Exchange hashpartitioning") == 1
