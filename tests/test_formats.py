"""Formats over typed rows and over JSON lines."""

import json

import pytest
from pyspark.sql import functions as F

from chatlake.formats import list_formats, load_format
from chatlake.formats.messages import FlaggedMessages
from chatlake.formats.registry import FLAGGED_MESSAGES, FLAT_CALLS, REPLY_MESSAGES
from chatlake.functions.template import CHATML, TURN_MARKERS
from chatlake.plans.dispatch import convert_all, remember, resolve_formats
from chatlake.sources import jsonl

MESSAGES = (
    "example_index long, messages array<struct<role:string,content:array<struct<type:string,text:string>>,"
    "train_on_turn:boolean,tool_calls:array<struct<function:struct<name:string,arguments:string>>>>>, tools string"
)


def turn(role, *texts, train=None, calls=None):
    return (role, [("text", t) for t in texts], train, calls)


def said(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_training_uses_flagged_replies(spark):
    row = (
        3,
        [turn("system", "S"), turn("user", "a", "dropped", train=True), turn("assistant", "b", train=True),
         turn("user", "c"), turn("assistant", "d", train=False), turn("model", "e", train=True)],
        None,
    )
    rows = spark.createDataFrame([row], MESSAGES)
    made = {r.turn_index: r for r in load_format(FLAGGED_MESSAGES).convert_for_training(rows).collect()}
    assert sorted(made) == [2, 5]
    assert made[2].prompt == said("system", "S") + said("user", "a")
    assert made[2].completion == said("assistant", "b")
    assert made[5].text == made[5].prompt + made[5].completion
    assert made[5].prompt.endswith(said("assistant", "d"))
    any_role = FlaggedMessages("x", any_role=True).convert_for_training(rows)
    assert sorted(r.turn_index for r in any_role.collect()) == [1, 2, 5]


def test_reply_format_trains_on_all_replies(spark):
    rows = spark.createDataFrame(
        [(0, [turn("user", "a"), turn("assistant", "b"), turn("tool", "t"), turn("model", "c")], "[]")], MESSAGES
    )
    made = load_format(REPLY_MESSAGES).convert_for_training(rows, TURN_MARKERS)
    assert [r.turn_index for r in made.orderBy("turn_index").collect()] == [1, 3]
    assert made.filter("turn_index = 1").first().completion == "<start_of_turn>model\nb<end_of_turn>\n"


def test_tools_and_calls_are_rendered(spark):
    rows = spark.createDataFrame(
        [(0, [turn("user", "a"), turn("assistant", calls=[(("f", '{"x":1}'),)])], '[{"name":"f"}]')], MESSAGES
    )
    text = load_format(REPLY_MESSAGES).convert_for_training(rows).first().text
    assert text.startswith('<|im_start|>system\n# Tools\n\n<tools>\n[{"name":"f"}]\n</tools><|im_end|>\n')
    assert text.endswith(
        '<|im_start|>assistant\n<tool_call>\n{"name":"f","arguments":{"x":1}}\n</tool_call><|im_end|>\n'
    )


def test_validation_reasons(spark):
    rows = spark.createDataFrame(
        [(0, None, None), (1, [], None), (2, [turn("user", "a"), turn(None, "b"), turn("x", "c")], None),
         (3, [turn("narrator", "a")], None), (4, [turn("tool", "a")], None)],
        MESSAGES,
    )
    fmt = load_format(FLAGGED_MESSAGES)
    got = {r.example_index: r.reason for r in fmt.rejects(rows).collect()}
    assert got == {
        0: "Missing 'messages' field",
        2: "Message 1 missing 'role'",
        3: "Message 0 has unsupported role: narrator",
    }
    assert sorted(r.example_index for r in fmt.valid(rows).collect()) == [1, 4]
    assert fmt.convert_for_eval(rows).count() == 0


def test_evaluation_cuts_at_last_reply(spark):
    rows = spark.createDataFrame(
        [(0, [turn("user", "a"), turn("assistant", "b"), turn("user", "c"),
              turn("assistant", "d", "x", calls=[(("f", None),), (("g", "{}"),)]), turn("user", "z")], None),
         (1, [turn("user", "a")], None)],
        MESSAGES,
    )
    made = load_format(FLAGGED_MESSAGES).convert_for_eval(rows).collect()
    assert len(made) == 1
    assert made[0].prompt == said("user", "a") + said("assistant", "b") + said("user", "c") + "<|im_start|>assistant\n"
    assert made[0].expected_text == "d"
    assert tuple(made[0].expected_tool) == ("f", "{}")


def test_content_variants(spark):
    text = spark.createDataFrame(
        [(0, [("user", "plain"), ("assistant", None)])], "example_index long, messages array<struct<role:string,content:string>>"
    )
    assert load_format(REPLY_MESSAGES).convert_for_training(text).first().text == said("user", "plain") + said("assistant", "")
    empty = spark.createDataFrame([(0, [turn("user"), turn("assistant", None)], None)], MESSAGES)
    assert load_format(REPLY_MESSAGES).convert_for_training(empty).first().text == said("user", "") + said("assistant", "")
    number = spark.createDataFrame(
        [(0, [("assistant", 5)])], "example_index long, messages array<struct<role:string,content:int>>"
    )
    assert load_format(REPLY_MESSAGES).convert_for_training(number).first().text == said("assistant", "")


FLAT = "example_index long, instructions string, tools string, input string, output string, tool_calls string"


def test_flat_format(spark):
    rows = spark.createDataFrame(
        [(0, "I", "[]", "q", None, '[{"function":{"name":"f","arguments":{"a":1}}},{"name":"g"}]'),
         (1, "I", '[{"name":"t"}]', "q", "out", '{"name":"f","arguments":"{}"}'),
         (2, None, "[]", "q", None, None), (3, "I", "{}", "q", None, None), (4, "I", "[]", None, None, None),
         (5, "I", "[]", "q", None, "[]")],
        FLAT,
    )
    fmt = load_format(FLAT_CALLS)
    assert {r.example_index: r.reason for r in fmt.rejects(rows).collect()} == {
        2: "Missing required field: 'instructions'",
        3: "'tools' must be a list",
        4: "Missing required field: 'input'",
    }
    made = {r.example_index: r for r in fmt.convert_for_eval(rows).collect()}
    assert sorted(made) == [0, 1, 5]
    assert made[0].prompt == said("system", "I") + said("user", "q") + "<|im_start|>assistant\n"
    assert tuple(made[0].expected_tool) == ("f", '{"a":1}')
    assert tuple(made[1].expected_tool) == ("f", "{}")
    assert made[1].prompt.startswith(CHATML.tools_before) and made[1].expected_text == "out"
    assert made[5].expected_tool is None
    assert not fmt.trains and fmt.convert_for_training(rows).count() == 0


def test_flat_format_needs_its_columns(spark):
    rows = spark.createDataFrame([(0, "q")], "example_index long, input string")
    fmt = load_format(FLAT_CALLS)
    assert fmt.rejects(rows).first().reason == "Missing required field: 'instructions'"
    assert fmt.convert_for_eval(rows).count() == 0
    typed = spark.createDataFrame([(0, "I", 5, 7)], "example_index long, instructions string, tools int, input int")
    assert fmt.rejects(typed).first().reason == "'tools' must be a list"


def test_typed_tool_calls(spark):
    rows = spark.createDataFrame(
        [(0, "I", ["t"], "q", ("f", (1, None)))],
        "example_index long, instructions string, tools array<string>, input string, "
        "tool_calls struct<name:string,arguments:struct<a:int,b:int>>",
    )
    made = load_format(FLAT_CALLS).convert_for_eval(rows).first()
    assert tuple(made.expected_tool) == ("f", '{"a":1}')
    assert '["t"]' in made.prompt


LINES = [
    json.dumps({"messages": [{"role": "user", "content": "é"}, {"role": "assistant", "content": [{"type": "text", "text": "b"}, {"text": "c"}], "train_on_turn": True}]}, ensure_ascii=False),
    "",
    "   \t ",
    "{broken",
    json.dumps({"messages": [{"role": "user", "content": '[{"text": "not a block"}]'}, {"role": "assistant", "content": 5, "train_on_turn": True, "extra": 1}]}),
    json.dumps({"other": 1}),
    "42",
    ' ' + json.dumps({"messages": [{"role": "model", "train_on_turn": True, "tool_calls": [{"function": {"name": "f", "arguments": {"a": 1}}}]}], "tools": [{"n": 1}]}) + " ",
]


@pytest.fixture
def lines(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return jsonl.scan(spark, str(tmp_path / "rows.jsonl"))


def test_json_lines_keep_an_index_for_broken_lines(spark, lines, tmp_path):
    got = {r.example_index: r.raw for r in lines.collect()}
    assert got == dict(enumerate(l.strip() for l in LINES if l.strip()))
    assert jsonl.line_count(spark, str(tmp_path / "rows.jsonl")).first().lines == len(got)


def test_json_lines_through_a_format(lines):
    fmt = load_format(FLAGGED_MESSAGES)
    rows = jsonl.parse_format(lines, fmt)
    assert sorted(r.example_index for r in rows.filter("problem is null").collect()) == [0, 2, 3, 5]
    assert rows.count() == len([l for l in LINES if l.strip()])
    made = {r.example_index: r for r in fmt.convert_for_training(rows).collect()}
    assert made[0].text == said("user", "é") + said("assistant", "b")
    assert made[2].text == said("user", '[{"text": "not a block"}]') + said("assistant", "")
    assert made[5].text.startswith(CHATML.tools_before + '[{"n":1}]') and '"arguments":{"a":1}' in made[5].text
    assert sorted(made) == [0, 2, 5]
    evaluated = {r.example_index: r for r in fmt.convert_for_eval(rows).collect()}
    assert tuple(evaluated[5].expected_tool) == ("f", '{"a":1}')
    assert evaluated[0].input == LINES[0]


def test_lines_over_many_files(spark, tmp_path):
    spark.range(100).select(F.format_string('{"n":%d}', "id").alias("value")).repartitionByRange(
        7, "value"
    ).sortWithinPartitions("value").write.text(str(tmp_path / "many"))
    rows = jsonl.parse(jsonl.scan(spark, str(tmp_path / "many")), "n:bigint")
    got = [r.n for r in rows.orderBy("example_index").collect()]
    assert got == sorted(range(100), key=lambda n: f'{{"n":{n}}}') and len({r.example_index for r in rows.collect()}) == 100


def test_registry():
    assert list_formats() == ["acon96-v2", "allenporter-fc", "allenporter-msg"]
    with pytest.raises(ValueError, match="Supported formats: acon96-v2, allenporter-fc, allenporter-msg"):
        load_format("xml")


def test_format_resolution(spark):
    remembered = resolve_formats(
        spark.createDataFrame([("a", FLAT_CALLS), ("b", REPLY_MESSAGES)], "dataset_id string, explicit_format string"),
        spark.createDataFrame([], "dataset_hash string, format string"),
    ).select("dataset_hash", "format")
    requests = spark.createDataFrame(
        [("a", None), ("b", FLAGGED_MESSAGES), ("c", None), ("d", "xml")], "dataset_id string, explicit_format string"
    )
    resolved = resolve_formats(requests, remembered)
    got = {r.dataset_id: (r.format, r.problem is None) for r in resolved.collect()}
    assert got == {"a": (FLAT_CALLS, True), "b": (FLAGGED_MESSAGES, True), "c": (None, False), "d": ("xml", False)}
    kept = {r.format for r in remember(resolved, remembered).collect()}
    assert kept == {FLAT_CALLS, FLAGGED_MESSAGES}


def test_convert_all(spark):
    rows = spark.createDataFrame([(0, [turn("assistant", "b", train=True)], None)], MESSAGES)
    flat = spark.createDataFrame([(0, "I", "[]", "q", None, None)], FLAT)
    data = {"m": (FLAGGED_MESSAGES, rows), "f": (FLAT_CALLS, flat)}
    assert [r.dataset_id for r in convert_all(data).collect()] == ["m"]
    assert sorted(r.dataset_id for r in convert_all(data, training=False).collect()) == ["f", "m"]
