"""Queries over loss logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatlake.operators.losslog import early_stop, parse_losses
from chatlake.queries.fixtures import LOG_SQL, log_lines, table
from chatlake.queries.scoring import in_files
from chatlake.session import staged_path
from chatlake.streaming.early_stop import monitor, read_state


def loss_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_losses(log_lines(table(spark, sf_dir, "events")))


def early_stop_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(loss_log_parse(spark, sf_dir))


def early_stop_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return early_stop(loss_log_parse(spark, sf_dir), patience=20)


def early_stop_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log comes in four files whose lines are in no order."""
    state = staged_path(spark, "early-stop")
    lines = in_files(log_lines(table(spark, sf_dir, "events")), ["line_no"], "log")
    monitor(lines, state, staged_path(spark, "stream")).awaitTermination()
    return read_state(spark, state)


QUERIES = {
    "loss_log_parse": loss_log_parse,
    "early_stop": early_stop_runs,
    "early_stop_patient": early_stop_patient,
    "early_stop_stream": early_stop_live,
}


def _stop_sql(patience: int) -> str:
    return LOG_SQL + f"""
    , placed AS (
      SELECT *, row_number() OVER w AS place,
             min(val_loss) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
      FROM losses WINDOW w AS (PARTITION BY run_id ORDER BY line_no)),
    since AS (
      SELECT *, place - max(CASE WHEN earlier IS NULL OR val_loss < earlier THEN place END) OVER (
                  PARTITION BY run_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS no_improve
      FROM placed),
    stops AS (
      SELECT run_id, min(place) FILTER (no_improve >= {patience}) AS stop_place FROM since GROUP BY run_id)
    SELECT run_id,
           arg_max(iter, place) FILTER (no_improve = 0) AS best_iter,
           arg_max(val_loss, place) FILTER (no_improve = 0) AS best_val_loss,
           max(iter) FILTER (place = stop_place) AS stop_iter
    FROM since JOIN stops USING (run_id)
    WHERE stop_place IS NULL OR place <= stop_place
    GROUP BY run_id"""


ORACLE = {
    "loss_log_parse": LOG_SQL + "SELECT run_id, line_no, iter, val_loss FROM losses",
    "early_stop": _stop_sql(2),
    "early_stop_patient": _stop_sql(20),
    "early_stop_stream": _stop_sql(2),
}
