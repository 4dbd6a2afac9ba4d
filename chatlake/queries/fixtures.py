"""Inputs of the scoring and log queries, derived from the event table.

Each event is one evaluation example. Its reply comes from the event at a
partner position (positions 3n+1 and 3n+2 swap), so replies are sometimes right
and have to be joined to the examples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.sources.parquet import raw_json


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def examples(events: DataFrame) -> DataFrame:
    """Expected calls: none for views, else the event type with its properties."""
    call = F.struct(F.col("event_type").alias("name"), F.col("props").alias("arguments"))
    return events.select(
        F.col("event_id").alias("example_index"),
        F.concat(F.lit("run_"), (F.col("event_id") % 10).cast("string")).alias("run_id"),
        "user_id",
        F.when(F.col("event_type") != "view", call.cast(schemas.TOOL_CALL)).alias("expected_tool"),
        F.lit("").alias("expected_text"),
        raw_json(["event_id", "event_type", "props"]).alias("input"),
    )


def predictions(events: DataFrame) -> DataFrame:
    """Replies in every form the scorer knows, and failed generations."""
    def call(name: str, arguments: str) -> str:
        return f"""concat('{{"name": "', {name}, '", "arguments": ', {arguments}, '}}')"""

    quoted = r"""concat('"', replace(props, '"', '\\"'), '"')"""
    text = f"""CASE
        WHEN event_id % 8 <= 1 THEN concat('<tool_call>\\n', {call("event_type", "props")}, '\\n</tool_call>')
        WHEN event_id % 8 = 2 THEN concat({call("event_type", "props")}, '\\n')
        WHEN event_id % 8 = 3 THEN concat('<tool_call>', {call("event_type", quoted)}, '</tool_call>')
        WHEN event_id % 8 = 4 THEN concat('<tool_call>\\n', {call("upper(event_type)", "props")}, '\\n</tool_call>')
        WHEN event_id % 8 = 5 THEN concat('There is no need to call ', event_type, '.')
        WHEN event_id % 8 = 6 THEN concat('<tool_call>{{"name": "', event_type, '", </tool_call>') END"""
    partner = "event_id + CASE event_id % 3 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END"
    return events.select(F.expr(partner).alias("example_index"), F.expr(text).alias("predicted_text"))


# The same two inputs in DuckDB.
SQL = r"""
WITH examples AS (
  SELECT event_id AS example_index, 'run_' || (event_id % 10) AS run_id, user_id,
         CASE WHEN event_type <> 'view' THEN event_type END AS expected_name,
         CASE WHEN event_type <> 'view' THEN props END AS expected_arguments,
         to_json({'event_id': event_id, 'event_type': event_type, 'props': props})::VARCHAR AS input
  FROM events),
replies AS (
  SELECT event_id + CASE event_id % 3 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS example_index,
         CASE event_id % 8
           WHEN 0 THEN '<tool_call>' || chr(10) || '{"name": "' || event_type || '", "arguments": ' || props || '}' || chr(10) || '</tool_call>'
           WHEN 1 THEN '<tool_call>' || chr(10) || '{"name": "' || event_type || '", "arguments": ' || props || '}' || chr(10) || '</tool_call>'
           WHEN 2 THEN '{"name": "' || event_type || '", "arguments": ' || props || '}' || chr(10)
           WHEN 3 THEN '<tool_call>{"name": "' || event_type || '", "arguments": "' || replace(props, '"', '\"') || '"}</tool_call>'
           WHEN 4 THEN '<tool_call>' || chr(10) || '{"name": "' || upper(event_type) || '", "arguments": ' || props || '}' || chr(10) || '</tool_call>'
           WHEN 5 THEN 'There is no need to call ' || event_type || '.'
           WHEN 6 THEN '<tool_call>{"name": "' || event_type || '", </tool_call>'
         END AS predicted_text
  FROM events),
joined AS (
  SELECT e.*, coalesce(r.predicted_text, '') AS predicted_text,
         r.predicted_text IS NULL AS generation_failed
  FROM examples e LEFT JOIN replies r USING (example_index)),
tagged AS (
  SELECT *, regexp_extract(predicted_text, '<tool_call>\s*(\{.*?\})\s*</tool_call>', 1, 's') AS in_tag,
         regexp_replace(predicted_text, '^\s+|\s+$', '', 'g') AS whole
  FROM joined),
bodies AS (
  SELECT *, CASE WHEN in_tag <> '' AND json_valid(in_tag) THEN in_tag
                 WHEN left(whole, 1) = '{' AND json_valid(whole) THEN whole END AS body
  FROM tagged),
calls AS (
  SELECT *, json_extract_string(body, '$.name') AS predicted_name,
         CASE WHEN json_type(body, '$.arguments') = 'VARCHAR'
              THEN json_extract_string(json_extract_string(body, '$.arguments'), '$.k')
              ELSE json_extract_string(body, '$.arguments.k') END AS predicted_k,
         json_extract_string(expected_arguments, '$.k') AS expected_k
  FROM bodies),
named AS (
  SELECT *, coalesce(lower(predicted_name) = lower(expected_name), FALSE)
            OR (predicted_name IS NULL AND expected_name IS NULL) AS tool_name_match,
         predicted_name IS NOT NULL AND expected_name IS NULL AS false_positive,
         predicted_name IS NULL AND expected_name IS NOT NULL AS false_negative
  FROM calls),
scored AS (
  SELECT *, tool_name_match AND (expected_name IS NULL OR predicted_k = expected_k) AS args_match,
         tool_name_match AND (expected_name IS NULL OR predicted_k = expected_k)
           AND NOT false_positive AS correct
  FROM named)
"""


def log_lines(events: DataFrame) -> DataFrame:
    """A trainer's log per user: a loss per event, every seventh line noise."""
    loss = F.concat(
        F.lit("[run] Iter "),
        F.col("event_id").cast("string"),
        F.lit(": Val loss "),
        F.format_string("%.2f", "value"),
        F.lit(", Val took 1.5s"),
    )
    noise = F.concat(F.lit("Iter "), F.col("event_id").cast("string"), F.lit(": Train loss 1.0"))
    return events.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id").alias("line_no"),
        F.when(F.col("event_id") % 7 == 3, noise).otherwise(loss).alias("line"),
    )


LOG_SQL = r"""
WITH lines AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS line_no,
         CASE WHEN event_id % 7 = 3 THEN 'Iter ' || event_id || ': Train loss 1.0'
              ELSE '[run] Iter ' || event_id || ': Val loss ' || printf('%.2f', value) || ', Val took 1.5s'
         END AS line
  FROM events),
losses AS (
  SELECT run_id, line_no,
         CAST(regexp_extract(line, 'Iter (\d+): Val loss ([0-9.]+)', 1) AS BIGINT) AS iter,
         CAST(regexp_extract(line, 'Iter (\d+): Val loss ([0-9.]+)', 2) AS DOUBLE) AS val_loss
  FROM lines WHERE regexp_matches(line, 'Iter (\d+): Val loss ([0-9.]+)'))
"""
