"""Loss logs and early stopping, finished and live."""

import pytest

from chatlake.operators.losslog import early_stop, parse_losses, runs_without_losses
from chatlake.streaming.early_stop import STATE, advance, monitor, read_state

LINES = "run_id string, line_no long, line string"


def losses(spark, runs):
    rows = [(run, n, (n + 1) * 10, float(v)) for run, values in runs.items() for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "run_id string, line_no long, iter long, val_loss double")


def outcome(frame):
    return {r.run_id: (r.best_iter, r.best_val_loss, r.stop_iter) for r in frame.collect()}


def test_parse(spark):
    texts = ["Iter 10: Val loss 1.5", "x Iter 7: Val loss 2, y Iter 8: Val loss 3", "Iter 5: Train loss 1",
             "Iter x: Val loss 1", "Iter 3: Val loss 1.2.3", "Iter 4: Val loss .", "iter 4: Val loss 1", ""]
    rows = spark.createDataFrame([("r", i, t) for i, t in enumerate(texts)], LINES)
    got = {r.line_no: (r.iter, r.val_loss) for r in parse_losses(rows).collect()}
    assert got == {0: (10, 1.5), 1: (7, 2.0)}


RUNS = {
    "equal": [3, 3, 3, 1],
    "late": [5, 4, 6, 6, 1],
    "down": [5, 4, 3, 2, 1],
    "one": [9],
    "bounce": [5, 6, 4, 5, 3, 4, 4, 1],
}


@pytest.mark.parametrize("block_rows", [2, 1 << 20])
@pytest.mark.parametrize(
    "patience, want",
    [
        (2, {"equal": (10, 3.0, 30), "late": (20, 4.0, 40), "down": (50, 1.0, None), "one": (10, 9.0, None),
             "bounce": (50, 3.0, 70)}),
        (1, {"equal": (10, 3.0, 20), "late": (20, 4.0, 30), "down": (50, 1.0, None), "one": (10, 9.0, None),
             "bounce": (10, 5.0, 20)}),
        (0, {"equal": (10, 3.0, 20), "late": (20, 4.0, 30), "down": (50, 1.0, None), "one": (10, 9.0, None),
             "bounce": (10, 5.0, 20)}),
        (5, {"equal": (40, 1.0, None), "late": (50, 1.0, None), "down": (50, 1.0, None), "one": (10, 9.0, None),
             "bounce": (80, 1.0, None)}),
    ],
)
def test_early_stop(spark, patience, want, block_rows):
    assert outcome(early_stop(losses(spark, RUNS), patience, block_rows=block_rows)) == want


def test_runs_without_validations(spark):
    done = early_stop(losses(spark, {"a": [1.0]}))
    runs = spark.createDataFrame([("a",), ("b",), ("b",)], "run_id string")
    got = {r.run_id: r.best_iter for r in runs_without_losses(runs, done).collect()}
    assert got == {"a": 10, "b": 0}


def as_lines(spark, runs, start, stop):
    rows = [
        (run, n, f"Iter {(n + 1) * 10}: Val loss {v}")
        for run, values in runs.items()
        for n, v in enumerate(values)
        if start <= n < stop
    ]
    return spark.createDataFrame(rows, LINES)


@pytest.mark.parametrize("step", [1, 2, 3])
def test_state_carried_over_batches_equals_one_log(spark, step):
    state = spark.createDataFrame([], STATE)
    for start in range(0, 8, step):
        # lines that were seen before come again and must not count twice
        state = advance(state, as_lines(spark, RUNS, max(0, start - 1), start + step), 2, block_rows=2)
        state = spark.createDataFrame(state.collect(), STATE)
    assert outcome(state) == outcome(early_stop(losses(spark, RUNS), 2))


def test_monitor_over_several_files(spark, tmp_path):
    source, state = tmp_path / "logs", str(tmp_path / "state")
    source.mkdir()
    checkpoint = str(tmp_path / "checkpoint")
    for start in range(0, 8, 3):
        as_lines(spark, RUNS, start, start + 3).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(str(source))
        monitor(stream, state, checkpoint).awaitTermination()
    assert outcome(read_state(spark, state)) == outcome(early_stop(losses(spark, RUNS), 2))
