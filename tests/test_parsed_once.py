"""Lines are parsed once, however their rows are filtered and used."""

import json

import pytest

from chatlake.formats import load_format
from chatlake.formats.registry import FLAGGED_MESSAGES, FLAT_CALLS, REPLY_MESSAGES
from chatlake.sources import jsonl

LINES = [
    {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "train_on_turn": True}]},
    {"messages": [{"role": "clown", "content": "q"}]},
    {"instructions": "i", "tools": [], "input": "x"},
]


@pytest.mark.parametrize("name", [FLAGGED_MESSAGES, REPLY_MESSAGES, FLAT_CALLS])
def test_filters_do_not_parse_again(spark, tmp_path, name):
    (tmp_path / "l.jsonl").write_text("\n".join([*map(json.dumps, LINES), "broken"]))
    fmt = load_format(name)
    rows = jsonl.parse_format(jsonl.scan(spark, str(tmp_path / "l.jsonl")), fmt)
    # conversion reads fields of valid rows once more, but no line
    for frame in (fmt.valid(rows), fmt.rejects(rows)):
        assert "from_json" not in frame._jdf.queryExecution().optimizedPlan().toString()
    found = {r.example_index: r.reason for r in fmt.validate(rows).select("example_index", "reason").collect()}
    assert set(found) == {0, 1, 2, 3} and found[3]
    good = 2 if name == FLAT_CALLS else 0
    assert [i for i, reason in sorted(found.items()) if reason is None] == [good]
