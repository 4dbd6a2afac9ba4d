"""Validation-loss logs: line parsing and early stopping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.operators.running import BLOCK_ROWS, earlier_blocks, inside_block, spread_by_block, with_keys

# Fixed value: how a trainer reports a validation.
LOSS_PATTERN = r"Iter (\d+): Val loss ([0-9.]+)"

DEFAULT_PATIENCE = 2


def parse_losses(lines: DataFrame, line: str = "line") -> DataFrame:
    """Validation losses in a log; other lines, and losses that are not a
    number such as ``1.2.3``, are left out."""
    text = F.col(line)
    return (
        lines.filter(text.rlike(LOSS_PATTERN))
        .withColumn("iter", F.regexp_extract(text, LOSS_PATTERN, 1).try_cast("long"))
        .withColumn("val_loss", F.regexp_extract(text, LOSS_PATTERN, 2).try_cast("double"))
        .filter(F.col("iter").isNotNull() & F.col("val_loss").isNotNull())
        .drop(line)
    )


def _best(loss: Column, place: Column, iteration: Column) -> Column:
    """Ordered first by loss and then by place, so the minimum of this struct
    is the first validation that reached the lowest loss."""
    return F.struct(loss.alias("loss"), place.alias("place"), iteration.alias("iter"))


def trace(
    losses: DataFrame,
    order: str = "line_no",
    carried: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Best loss so far and validations since, after each validation of a run.

    The last improvement is the first place where the running minimum was
    reached, so one running minimum over (loss, place) answers both. ``carried``
    continues runs from an earlier state (see ``carry``).

    Adds ``place`` (1-based), ``best`` (struct), ``no_improve`` and ``_block``.
    What a block adds up to stands in its last row, so nothing is aggregated.
    """
    keys = ["run_id"]
    local = inside_block(order)
    narrow = losses.select("run_id", order, "iter", "val_loss")
    spread = spread_by_block(narrow, keys, order, block_rows).drop(*keys)
    # the place inside the block first, then the best among the block's rows so far
    placed = spread.withColumn("_local_place", F.count("*").over(local))
    candidate = _best(F.col("val_loss"), F.col("_local_place"), F.col("iter"))
    scanned = placed.withColumn("_local_best", F.min(candidate).over(local))
    totals = (
        scanned.withColumn("_next", F.lead(order).over(Window.partitionBy("_block").orderBy(order)))
        .filter(F.col("_next").isNull())
        .select("_block", F.col("_local_place").alias("_n"), F.col(order).alias("_last"), F.col("_local_best").alias("_best"))
    )
    before = earlier_blocks(keys)
    counted = with_keys(totals, keys).withColumn("_n_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    shifted = counted.withColumn("_best", _shift(F.col("_best"), F.col("_n_before")))
    state = shifted.select("run_id", "_block", "_n_before", F.min("_best").over(before).alias("_best_before"))
    if carried is not None:
        # places of carried bests are zero or negative: validations before this batch
        known = carried.select(
            F.col("run_id").alias("_run"), _best(F.col("best_val_loss"), -F.col("no_improve"), F.col("best_iter")).alias("_known")
        )
        state = (
            state.join(known, state["run_id"].eqNullSafe(known["_run"]), "left")
            .drop("_run")
            .withColumn("_best_before", F.least("_known", "_best_before"))
            .drop("_known")
        )
    best = F.least("_best_before", _shift(F.col("_local_best"), F.col("_n_before")))
    return (
        scanned.join(state, "_block")
        .withColumn("place", F.col("_local_place") + F.col("_n_before"))
        .withColumn("best", best)
        .withColumn("no_improve", F.col("place") - F.col("best.place"))
        .select("run_id", order, "iter", "val_loss", "place", "best", "no_improve", "_block")
    )


def _shift(best: Column, by: Column) -> Column:
    return _best(best.getField("loss"), best.getField("place") + by, best.getField("iter"))


def stop_points(traced: DataFrame, patience: int, order: str = "line_no") -> DataFrame:
    """First validation of each run at which training stops, and the state
    there; for runs that never stop, the state after the last validation.

    Of every block the first stop and the last row are kept, in the order the
    block has already, so a run sends few rows on, however long it is.
    """
    stopped = F.col("no_improve") >= max(patience, 1)
    block = Window.partitionBy("_block").orderBy(order)
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    few = (
        traced.withColumns(
            {"_stopped": stopped, "_stops": F.count_if(stopped).over(so_far), "_next": F.lead(order).over(block)}
        )
        .filter(F.col("_stopped") & (F.col("_stops") == 1) | F.col("_next").isNull())
    )
    run = Window.partitionBy("run_id")
    first = run.orderBy(F.col("_stopped").desc(), F.when(F.col("_stopped"), F.col("place")).otherwise(-F.col("place")))
    ends = few.withColumns(
        {"_rank": F.row_number().over(first), "_last_line": F.max(order).over(run)}
    ).filter("_rank = 1")
    return ends.select(
        "run_id",
        F.col("best.iter").alias("best_iter"),
        F.col("best.loss").alias("best_val_loss"),
        F.when(F.col("_stopped"), F.col("iter")).alias("stop_iter"),
        "no_improve",
        F.col("_last_line").cast("long").alias("last_line"),
    )


def early_stop(
    losses: DataFrame,
    patience: int = DEFAULT_PATIENCE,
    order: str = "line_no",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Best iteration per run under early stopping.

    Validations are read in the order of the integer ``order``, unique in a
    run. A loss improves when strictly below all earlier ones; the run stops at
    the ``patience``-th validation in a row without improvement (at the first
    one for patience 0) and later lines are ignored. ``stop_iter`` is null when
    the run went to its end.
    """
    traced = trace(losses, order, block_rows=block_rows)
    return stop_points(traced, patience, order).drop("no_improve", "last_line")


def runs_without_losses(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Add runs whose log held no validation, with best iteration 0."""
    return runs.select("run_id").distinct().join(results, "run_id", "left").withColumn(
        "best_iter", F.coalesce("best_iter", F.lit(0).cast("long"))
    )
