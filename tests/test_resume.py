"""Generation whose parts are many: few jobs, and replies that a broken job leaves."""

import time

import pytest

from chatlake import inference
from chatlake.inference import generate, read_predictions


def model(broken=None):
    def load_model():
        def reply(prompt, max_tokens, temperature):
            if prompt == broken:
                time.sleep(8)
                raise SystemExit
            if prompt == "fails":
                raise ValueError(prompt)
            return prompt.upper()

        return reply

    return load_model


def test_many_parts_take_few_jobs(spark, tmp_path):
    out = tmp_path / "replies"
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(400)] + [(5, "q5"), (7000, "far"), (7001, "fails")], "example_index long, prompt string")
    done = {r.example_index: r for r in generate(rows, model(), str(out), attempts=2, prompts_per_commit=4).collect()}
    assert set(done) == {*range(400), 7000, 7001}
    assert (done[5].predicted_text, done[5].attempts, done[399].predicted_text) == ("P5", 2, "P399")
    assert (done[7001].predicted_text, done[7001].generation_error, done[7001].attempts) == (None, "ValueError: fails", 2)
    assert len(list(out.glob("part_*"))) <= inference.MOST_JOBS + 1


def test_a_broken_job_leaves_what_its_finished_tasks_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inference, "MOST_JOBS", 1)
    out = str(tmp_path / "replies")
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "example_index int, prompt string")
    with pytest.raises(Exception):
        generate(rows, model("p17"), out, prompts_per_commit=5)
    left = {r.example_index: r.attempts for r in read_predictions(spark, out).collect()}
    assert 20 <= len(left) < 40 and 17 not in left
    done = generate(rows, model(), out, prompts_per_commit=5).collect()
    assert {r.example_index: (r.predicted_text, r.attempts) for r in done} == {i: (f"P{i}", 1) for i in range(40)}
