"""Values of any JSON kind in JSON lines are judged as a reader of JSON objects would."""

import json

import pytest
from pyspark.sql import functions as F

from chatlake.formats import load_format
from chatlake.formats.registry import FLAGGED_MESSAGES, FLAT_CALLS
from chatlake.functions import messages as M
from chatlake.sources import jsonl

VALUES = ["true", "false", "null", "1", "0", "0.0", "-0.0", "0e5", "1e-400", "2.5", '"yes"', '""', '"0"', '"false"', '"0.0"', '"[]"', '"{}"', "[]", "{}", "[0]", '{"a":0}', '" "', '"true"', "[ ]", "12345678901234567890"]


def rows_of(spark, tmp_path, lines, name):
    (tmp_path / "l.jsonl").write_text("\n".join(lines), encoding="utf-8")
    fmt = load_format(name)
    return fmt, jsonl.parse_format(jsonl.scan(spark, str(tmp_path / "l.jsonl")), fmt)


def reasons(fmt, rows):
    return {r.example_index: r.reason for r in fmt.rejects(rows).collect()}


@pytest.mark.parametrize("key", ['"train_on_turn"', '"train_on_t\\u0075rn"'])
def test_flags_of_every_kind(spark, tmp_path, key):
    ask = '{"role":"user","content":"q"}'
    lines = ['{"messages":[%s,{"role":"assistant","content":"a",%s : %s}]}' % (ask, key, v) for v in VALUES]
    lines.append('{"messages":[%s,{"role":"assistant","content":"a"}]}' % ask)
    fmt, rows = rows_of(spark, tmp_path, lines, FLAGGED_MESSAGES)
    want = {i for i, line in enumerate(lines) if json.loads(line)["messages"][1].get("train_on_turn")}
    assert 0 < len(want) < len(lines)
    assert {r.example_index for r in fmt.convert_for_training(rows).collect()} == want
    assert reasons(fmt, rows) == {}


def message_reason(row):
    if "messages" not in row:
        return M.NO_MESSAGES
    if not isinstance(row["messages"], list):
        return M.NO_LIST
    for i, m in enumerate(row["messages"]):
        if not isinstance(m, dict) or m.get("role") is None:
            return f"Message {i} missing 'role'"
        if m["role"] not in M.SUPPORTED_ROLES:
            return f"Message {i} has unsupported role: {m['role']}"
    return None


def test_messages_are_read_one_by_one(spark, tmp_path):
    ok = '{"role":"assistant","content":"a","train_on_turn":true}'
    elements = ['"text"', "5", "null", "[1]", "true", '"{\\"role\\":\\"user\\"}"', "{}", '{"role":"clown"}', '{"role":null}', '{"role":7}', ok, '{"role":"user","content":[1,2]}']
    lines = ['{"messages":%s}' % v for v in ['"hello"', "null", "{}", "7", "true", "[]", '"[]"', '{"role":"user"}']] + ["{}", '{"message":[]}']
    for e in elements:
        lines += ['{"messages":[%s]}' % e, '{"messages":[%s,%s,{"role":"clown"}]}' % (ok, e), '{"tools":[],"messages":[%s,"x"]}' % e]
    lines.append('{"messages":[%s,"x"],"messages":[%s]}' % (ok, ok))
    lines.append('{"messages":[%s,{"role":"user","role":"tool","content":"t"},"x"]}' % ok)
    fmt, rows = rows_of(spark, tmp_path, lines, FLAGGED_MESSAGES)
    want = {i: r for i, line in enumerate(lines) if (r := message_reason(json.loads(line)))}
    assert reasons(fmt, rows) == want
    made = {r.example_index for r in fmt.convert_for_training(rows).collect()}
    assert made == {i for i, line in enumerate(lines) if i not in want and any(m.get("train_on_turn") for m in json.loads(line)["messages"])}


def flat_reason(row):
    for field in ("instructions", "tools", "input"):
        if field not in row:
            return f"Missing required field: '{field}'"
    if not isinstance(row["tools"], list):
        return "'tools' must be a list"
    return None if isinstance(row["input"], str) else "'input' must be a string"


def test_flat_fields_of_every_kind(spark, tmp_path):
    tools = ["[]", '[{"name":"f"}]', '["x"]', '"[x]"', '"[]"', '" [1]"', "5", "{}", "null", "true", '"t"']
    texts = ['"turn on"', '"5"', "5", '["l"]', '"[l]"', "{}", '"{}"', "null", "true", '"true"', '""', "-1.5"]
    lines = ['{"instructions":"i","tools":%s,"input":"q"}' % t for t in tools]
    lines += ['{"instructions":"i","to\\u006fls":%s,"input":"q"}' % t for t in tools]
    lines += ['{"instructions":"i","tools":[],"input":%s}' % t for t in texts]
    lines += ['{"tools":5,"input":5}', '{"instructions":"i","input":5}', '{"instructions":"i","tools":5}', '{"instructions":"i","tools":5,"input":5}']
    lines += ['{"instructions":"i","tools":"[]","tools":[],"input":"q"}', '{"instructions":"i","tools":[{"tools":"[x]"}],"input":"q"}']
    fmt, rows = rows_of(spark, tmp_path, lines, FLAT_CALLS)
    want = {i: r for i, line in enumerate(lines) if (r := flat_reason(json.loads(line)))}
    assert reasons(fmt, rows) == want
    made = fmt.convert_for_eval(rows).collect()
    assert {r.example_index for r in made} == set(range(len(lines))) - set(want)
    for r in made:
        assert f"<|im_start|>user\n{json.loads(lines[r.example_index])['input']}<|im_end|>" in r.prompt


def test_truth_of_typed_columns(spark):
    kinds = {"boolean": ["true", "false", None], "int": ["2", "0", None], "double": ["-0.0D", "double('NaN')", "0.5D"], "string": ["'yes'", "''", "'false'", None]}
    want = {"boolean": [True, False, False], "int": [True, False, False], "double": [False, True, True], "string": [True, False, True, False]}
    for kind, values in kinds.items():
        typed = ", ".join(f"struct('assistant' AS role, cast({v or 'null'} AS {kind}) AS train_on_turn)" for v in values)
        rows = spark.range(1).select(F.expr(f"array({typed})").alias("m"))
        done = rows.select(M.normalize(F.col("m"), rows.schema["m"].dataType).alias("m")).first().m
        assert [m.train_on_turn for m in done] == want[kind]
