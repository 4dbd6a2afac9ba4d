"""Nothing valid is lost: long texts, repeated keys, null keys, late lines, equal names."""

import json
import random

import pytest
from pyspark.sql import functions as F

from chatlake.formats import load_format
from chatlake.formats.registry import FLAGGED_MESSAGES, REPLY_MESSAGES
from chatlake.functions import toolcall as C
from chatlake.functions.messages import is_reply
from chatlake.operators import turns as R
from chatlake.operators.losslog import early_stop, parse_losses
from chatlake.operators.scoring import attach_predictions, score
from chatlake.plans.build import Dataset, build_missing, training_splits
from chatlake.sources import jsonl, manifest
from chatlake.streaming.early_stop import monitor, read_state

ASK = '{"role":"assistant","content":"a"}'


def contents(spark, tmp_path, lines):
    (tmp_path / "l.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = jsonl.parse_format(jsonl.scan(spark, str(tmp_path / "l.jsonl")), load_format(REPLY_MESSAGES))
    return {r.example_index: r.c for r in rows.select("example_index", F.col("messages")[0]["content"].alias("c")).collect()}


def test_lines_keep_their_content(spark, tmp_path):
    long = "x" * 21_000_000
    values = ['"a __end_of_value b"', '"[note] hi"', '[{"type":"text","text":"[b]"}]', '"[1]"', "5", '"5"', "true", '"true"', '{"a":1}', '"{}"', '"NaN"', "[]", "null", f'"{long}"']
    want = ["a __end_of_value b", "[note] hi", "[b]", "[1]", "", "5", "", "true", "", "{}", "NaN", "", "", long]
    lines = ['{"id":1,"messages":[{"role":"user","content":%s},%s],"id":2}' % (v, ASK) for v in values]
    assert contents(spark, tmp_path, lines) == dict(enumerate(want))


def test_calls_of_any_length_and_repeated_keys(spark):
    long = "y" * 20_500_000
    replies = ['{"name":"f","arguments":{"k":1,"k":2}}', '{"name":"f","arguments":{"k":"%s"}}' % long, '{"name":"f","arguments":{"k":"__end_of_value"}}']
    expected = ['{"k":2}', '{"k":"%s"}' % long, '{"z":1,"k":"__end_of_value","z":null,"k":"__end_of_value"}']
    examples = spark.createDataFrame([(i, ("f", e)) for i, e in enumerate(expected)], "example_index long, expected_tool struct<name:string,arguments:string>")
    predictions = spark.createDataFrame(list(enumerate(replies)), "example_index long, predicted_text string")
    got = {r.example_index: r.args_match for r in score(attach_predictions(examples, predictions)).collect()}
    assert got == {0: True, 1: True, 2: False}
    maps = C.with_arguments(spark.createDataFrame([('{"k":1,"z":2,"k":null}',)], "a string"), {"m": F.col("a")})
    assert maps.first().m == {"k": None, "z": "2"}


def test_repeated_predictions_do_not_multiply(spark):
    examples = spark.createDataFrame([(0,), (1,)], "example_index long")
    twice = spark.createDataFrame([(0, "b"), (0, "a"), (0, None)], "example_index long, predicted_text string")
    got = sorted(map(tuple, attach_predictions(examples, twice).collect()))
    assert got == [(0, False, "a"), (1, True, "")]


def test_broken_lines_count_in_the_split(spark, tmp_path):
    lines = ["broken", "{"] + ['{"messages":[{"role":"user","content":"q"},%s]}' % ASK] * 8
    (tmp_path / "l.jsonl").write_text("\n".join(lines))
    rows = jsonl.parse_format(jsonl.scan(spark, str(tmp_path / "l.jsonl")), load_format(REPLY_MESSAGES))
    made = training_splits(rows, REPLY_MESSAGES)
    assert {r.example_index: r.split for r in made.collect()} == {**{i: "train" for i in range(2, 8)}, 8: "valid", 9: "test"}
    assert {r.example_index for r in load_format(REPLY_MESSAGES).rejects(rows).collect()} == {0, 1}


TURNS = [("a", None, "user", "n"), ("a", -3, "user", "m"), ("a", 0, "user", "q"), ("a", 1, "assistant", "r"),
         (None, 0, "user", "nq"), (None, 1, "assistant", "nr"), ("b", 0, "assistant", "x"), ("c", None, "assistant", "only"),
         ("d", 0, None, "bad"), ("d", 1, "assistant", "z")]


def test_both_sides_of_the_block_switch_agree(spark):
    schema = "conv_id string, turn int, role string, text string"
    reply = is_reply(F.col("role"))
    long = [("long", i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(11)]

    def outcome(rows):
        turns = spark.createDataFrame(rows, schema)
        made = R.training_rows(R.rendered_blocks(turns, reply, block_turns=4)).filter("conv_id is null or conv_id <> 'long'")
        prompts = R.evaluation_prompts(R.rendered_blocks(turns, reply, block_turns=4)).filter("conv_id is null or conv_id <> 'long'")
        split = R.split_training_rows(turns, reply, block_turns=4)
        assert {(r.conv_id, r.turn_index) for r in split.collect() if r.conv_id != "long"} == {(r.conv_id, r.turn_index) for r in made.collect()}
        counts = {r.split: r.examples for r in R.split_counts(turns, reply).collect()}
        assert counts == {r.split: r.n for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
        return sorted(map(tuple, made.collect()), key=repr), sorted(map(tuple, prompts.collect()), key=repr)

    short = outcome(TURNS)
    assert short == outcome(TURNS + long)
    assert {r[0] for r in short[0]} == {"a", None, "b", "c"}
    assert next(r for r in short[1] if r[0] == "a")[2].count("<|im_start|>") == 4


def test_prompt_of_a_long_conversation_is_its_whole_text(spark):
    rows = [("long", i, "assistant" if i == 9 else "user", f"t{i}") for i in range(14)] + [("none", i, "user", "u") for i in range(9)]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = R.evaluation_prompts(R.rendered_blocks(turns, is_reply(F.col("role")), block_turns=3)).collect()
    want = "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(9)) + "<|im_start|>assistant\n"
    assert [tuple(r) for r in got] == [("long", 9, want)]


def test_split_counts_move_no_text(spark):
    turns = spark.createDataFrame(TURNS, "conv_id string, turn int, role string, text string")
    plan = R.split_counts(turns, is_reply(F.col("role")))._jdf.queryExecution().optimizedPlan().toString()
    assert "text#" not in plan.split("LogicalRDD")[0].split("Project")[0]


def test_early_stop_sorts_no_rows_for_aggregates(spark):
    lines = spark.createDataFrame([("r", 1, "Iter 1: Val loss 2.0")], "run_id string, line_no long, line string")
    plan = early_stop(parse_losses(lines))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_monitor_takes_lines_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    schema = "run_id string, line_no long, line string"
    rows = [(run, n, f"Iter {10 * n}: Val loss {rng.randrange(9)}.5") for run in ("a", "b", None) for n in range(12)]
    want = {tuple(r) for r in early_stop(parse_losses(spark.createDataFrame(rows, schema))).collect()}
    assert len(want) == 3
    rng.shuffle(rows)
    source = tmp_path / "logs"
    source.mkdir()
    for i in range(0, len(rows), 12):
        (source / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("run_id", "line_no", "line"), r))) for r in rows[i : i + 12]))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    state = str(tmp_path / "state")
    monitor(stream, state, str(tmp_path / "checkpoint"), trigger={"availableNow": True}).awaitTermination()
    assert {tuple(r) for r in read_state(spark, state).collect()} == want


def test_two_formats_of_one_dataset_are_two_builds(spark, tmp_path):
    rows = spark.createDataFrame([(i, [("user", "q"), ("assistant", "a")]) for i in range(10)], "example_index long, messages array<struct<role:string,content:string>>")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    wanted = [Dataset("d", name, rows, "x") for name in (REPLY_MESSAGES, FLAGGED_MESSAGES)]
    done = build_missing(spark, wanted, out, log).collect()
    assert len({r.build_key for r in done}) == 2 and {r.format for r in done} == {REPLY_MESSAGES, FLAGGED_MESSAGES}
    assert spark.read.parquet(out).count() == 10


def test_equal_names_in_two_folders(spark, tmp_path):
    for folder, size in (("x", 3), ("y z", 5)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "data.parquet").write_bytes(b"x" * size)
    files = manifest.inventory(spark, str(tmp_path))
    wanted = spark.createDataFrame([("x/data.parquet", 3), ("y z/data.parquet", 5)], "file string, size long")
    assert {(r.file, r.status) for r in manifest.check(files, wanted).collect()} == {("x/data.parquet", "ok"), ("y z/data.parquet", "ok")}
