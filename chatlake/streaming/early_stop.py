"""Early stopping over a stream of log lines, many runs at once.

Each micro-batch goes through the same distributed scan as a finished log,
continued from a small table with one row per run. So a run that writes most of
the lines is still spread over tasks, which state kept per key would not do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatlake.operators.losslog import DEFAULT_PATIENCE, LOSS_PATTERN, parse_losses, stop_points, trace
from chatlake.operators.running import BLOCK_ROWS
from chatlake.session import checkpointed, lookup

STATE = (
    "run_id string, best_iter long, best_val_loss double, stop_iter long, "
    "no_improve long, last_line long"
)


def _slot(path: str, batch: int) -> str:
    return f"{path}/slot_{batch % 2}"


def advance(
    state: DataFrame,
    lines: DataFrame,
    patience: int = DEFAULT_PATIENCE,
    block_rows: int = BLOCK_ROWS,
    history: DataFrame | None = None,
) -> DataFrame:
    """State of all runs after more lines.

    ``history`` holds all losses so far, those of ``lines`` included. Runs that
    got a line at or before the last one seen are worked out anew from it.
    Without a history such lines count as seen before and are ignored. Lines
    behind the stop of a run change nothing.
    """
    changed = _changed(state, lines, patience, block_rows, history)
    return _merged(state, changed)


def _changed(state: DataFrame, lines: DataFrame, patience: int, block_rows: int, history: DataFrame | None) -> DataFrame:
    seen = state.select(F.col("run_id").alias("_run"), "last_line", F.col("stop_iter").isNotNull().alias("_stopped"))
    losses = parse_losses(lines)
    known = losses.join(lookup(seen), F.col("run_id").eqNullSafe(F.col("_run")), "left")
    late = F.coalesce(F.col("line_no") <= F.col("last_line"), F.lit(False))
    fresh = known.filter(~late & ~F.coalesce("_stopped", F.lit(False))).select(*losses.columns)
    if history is None:
        return stop_points(trace(fresh, carried=state, block_rows=block_rows), patience)
    again = lookup(checkpointed(known.filter(late).select(F.struct("run_id").alias("_late")).distinct()))

    def of_runs(rows: DataFrame, how: str) -> DataFrame:
        return rows.withColumn("_late", F.struct("run_id")).join(again, "_late", how).drop("_late")

    onward = stop_points(trace(of_runs(fresh, "left_anti"), carried=state, block_rows=block_rows), patience)
    whole = of_runs(history, "left_semi").dropDuplicates(["run_id", "line_no"])
    return onward.unionByName(stop_points(trace(whole, block_rows=block_rows), patience))


def _merged(state: DataFrame, changed: DataFrame) -> DataFrame:
    new = changed.select(F.col("run_id").alias("_run"))
    unchanged = state.join(new, F.col("run_id").eqNullSafe(F.col("_run")), "left_anti")
    return changed.unionByName(unchanged)


def monitor(
    lines: DataFrame,
    state_path: str,
    checkpoint: str,
    patience: int = DEFAULT_PATIENCE,
    block_rows: int = BLOCK_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the monitor on a stream of ``run_id``, ``line_no``, ``line``.

    ``trigger`` holds arguments of the stream's trigger, such as
    ``{"processingTime": "10 seconds"}`` to follow running trainers; by default
    what is available is worked off.

    A batch reads the state its predecessor wrote and writes the other of two
    slots, so a batch that is repeated after a failure gives the same state.
    The losses of each batch are kept beside it, for runs whose lines come out
    of order.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = (
            spark.createDataFrame([], STATE)
            if batch_id == 0
            else spark.read.schema(STATE).parquet(_slot(state_path, batch_id - 1))
        )
        kept = f"{state_path}/losses"
        batch.filter(F.col("line").rlike(LOSS_PATTERN)).select("run_id", "line_no", "line").write.mode("overwrite").parquet(
            f"{kept}/batch={batch_id}"
        )
        stored = spark.read.schema("run_id string, line_no long, line string, batch long").parquet(kept)
        stored = stored.filter(F.col("batch") <= batch_id)
        own = stored.filter(F.col("batch") == batch_id).drop("batch")
        history = parse_losses(stored.drop("batch"))
        # written first, since the merged state reads it twice
        moved = f"{state_path}/changed_{batch_id % 2}"
        _changed(before, own, patience, block_rows, history).write.mode("overwrite").parquet(moved)
        after = _merged(before, spark.read.schema(STATE).parquet(moved))
        after.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            _slot(state_path, batch_id)
        )

    return (
        lines.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The newest state of all runs, in the layout of ``early_stop``."""
    slots = spark.read.schema(STATE + ", batch_id int").parquet(f"{state_path}/slot_*")
    newest = slots.agg(F.max("batch_id")).first()[0]
    return slots.filter(F.col("batch_id") == newest).select(
        "run_id", "best_iter", "best_val_loss", "stop_iter"
    )
