"""Queries over tool calls, scores and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.formats import base
from chatlake.formats.registry import FLAT_CALLS
from chatlake.functions import messages as M
from chatlake.functions import toolcall as C
from chatlake.inference import generate, predict
from chatlake.operators import metrics
from chatlake.operators.ordering import first_examples
from chatlake.operators.scoring import attach_predictions, results, score
from chatlake.plans.evaluation import evaluate
from chatlake.plans.report import first_failures, report
from chatlake.queries.fixtures import SQL, examples, predictions, table
from chatlake.session import checkpointed, staged_path
from chatlake.streaming.accuracy import accuracy_stream, final_summary

FLAGS = ["tool_name_match", "args_match", "false_positive", "false_negative", "correct"]


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return attach_predictions(examples(events), predictions(events))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_joined(spark, sf_dir))


def prediction_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select("example_index", "predicted_text", "generation_failed")


def expected_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls in wrapped and bare form, or none; the first one is expected."""
    bare = F.struct(F.col("event_type").alias("name"), F.col("props").alias("arguments"))
    wrapped = bare.cast("struct<name:string,arguments:string>")
    nothing = F.lit(None).cast("struct<name:string,arguments:string>")
    form = F.col("event_id") % 3
    call = F.struct(
        F.when(form == 0, wrapped).otherwise(nothing).alias("function"),
        F.when(form == 1, F.col("event_type")).alias("name"),
        F.when(form == 1, F.col("props")).alias("arguments"),
    )
    other = F.struct(nothing.alias("function"), F.lit("other").alias("name"), F.lit("{}").alias("arguments"))
    calls = F.when(F.col("event_type") == "view", F.array().cast(
        "array<struct<function:struct<name:string,arguments:string>,name:string,arguments:string>>"
    )).otherwise(F.array(call, other))
    rows = table(spark, sf_dir, "events").select("event_id", calls.alias("tool_calls"))
    first = F.try_element_at(M.tool_calls(*base.column(rows, "tool_calls")), F.lit(1))
    return rows.select("event_id", first.alias("call")).select(
        "event_id", F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments")
    )


def parse_tool_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    called = C.with_tool_call(_joined(spark, sf_dir))
    parsed = C.with_arguments(called, {"arguments": F.col("predicted_tool.arguments")})
    return parsed.select(
        "example_index",
        F.col("predicted_tool.name").alias("name"),
        F.try_element_at("arguments", F.lit("k")).alias("k"),
    )


def args_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arguments of neighbouring events compared without regard to names."""
    called = C.with_tool_call(_joined(spark, sf_dir))
    maps = C.with_arguments(
        called, {"p": F.col("predicted_tool.arguments"), "e": F.col("expected_tool.arguments")}
    )
    return maps.select("example_index", C.arguments_match("p", "e").alias("args_match"))


def score_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("example_index", "generation_failed", *FLAGS)


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = results(_scored(spark, sf_dir))
    return rows.select(
        "example_index",
        "input",
        F.col("expected_tool.name").alias("expected_name"),
        F.col("score.predicted_tool.name").alias("predicted_name"),
        F.col("score.predicted_text").alias("predicted_text"),
        F.col("score.correct").alias("correct"),
    )


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.summarize(_scored(spark, sf_dir), ["run_id"])


def eval_summary_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.summarize(_scored(spark, sf_dir))


def failure_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.failure_count(_scored(spark, sf_dir), ["run_id"])


def failure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_failures(_scored(spark, sf_dir)).select(
        "example_index",
        "input",
        F.col("expected_tool.name").alias("expected_name"),
        F.col("predicted_tool.name").alias("predicted_name"),
        "predicted_text",
    )


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # summary, failures and their count all read the scored rows
    scored = checkpointed(_scored(spark, sf_dir))
    meta = table(spark, sf_dir, "events").agg(F.count("*").alias("n")).select(
        F.lit("m").alias("model"),
        F.lit("events").alias("dataset"),
        F.lit("flat").alias("format"),
        F.lit("2024-01-01 00:00:00").alias("date"),
        F.concat(F.lit("r"), F.col("n").cast("string")).alias("run_id"),
    )
    return report(scored, metrics.summarize(scored), meta)


def evaluation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole evaluation of the benchmark, read back from its files: results beside the
    run's settings and totals."""
    items = table(spark, sf_dir, "benchmark")
    rows = items.select(
        F.col("item_id").alias("example_index"),
        F.lit("Answer.").alias("instructions"),
        F.lit("[]").alias("tools"),
        F.when(F.col("item_id") % 5 != 3, F.col("text")).alias("input"),
    )
    replies = items.select(F.col("item_id").alias("example_index"), F.expr(
        """CASE WHEN item_id % 3 = 0 THEN '<tool_call>{"name":"f"}</tool_call>' ELSE text END"""
    ).alias("predicted_text"))
    path = staged_path(spark, "evaluation")
    evaluate(rows, replies, path, model="m", dataset="benchmark", format_name=FLAT_CALLS, run_id="r", max_tokens=64, input_chars=None)
    head = spark.read.schema(
        "meta struct<model:string,max_tokens:int,temperature:double,raw_total:long,scored_total:long,skipped:long>, summary struct<total:long,correct:long>"
    ).json(f"{path}/summary")
    made = spark.read.schema("example_index long, score struct<correct:boolean,predicted_text:string>").json(f"{path}/results")
    # one row, under a constant key
    run = head.select(F.lit(1).alias("_k"), "meta.*", F.col("summary.total").alias("total"), F.col("summary.correct").alias("total_correct"))
    rows = made.select(F.lit(1).alias("_k"), "example_index", "score.correct", "score.predicted_text")
    return rows.join(F.broadcast(run), "_k").drop("_k")


def eval_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first-n limit, which counts raw examples."""
    events = table(spark, sf_dir, "events")
    limited = first_examples(examples(events), 500)
    return score(attach_predictions(limited, predictions(events))).select("example_index", "correct")


def running_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    ran = metrics.running_accuracy(_scored(spark, sf_dir), ["user_id"])
    return ran.select("user_id", "example_index", F.round("accuracy_so_far", 6).alias("accuracy_so_far"))


def predict_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic stand-in for a model: calls a tool with the prompt's length."""

    def load_model():
        def generate(prompt, max_tokens, temperature):
            return '<tool_call>{"name":"echo","arguments":{"n":%d}}</tool_call>' % len(prompt)

        return generate

    prompts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))
    called = C.with_tool_call(predict(prompts, load_model))
    parsed = C.with_arguments(called, {"arguments": F.col("predicted_tool.arguments")})
    return parsed.select(
        "doc_id",
        F.col("predicted_tool.name").alias("name"),
        F.try_element_at("arguments", F.lit("n")).cast("long").alias("n"),
    )


def predict_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies to all documents, by a model that breaks off, goes on, and fails for ever on some
    prompts: in the end each prompt has its reply or its last error, and how often it was tried."""
    path = staged_path(spark, "replies")
    prompts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("example_index"), F.col("text").alias("prompt"))

    def model(broken):
        def load_model():
            def reply(prompt, max_tokens, temperature):
                if len(prompt) % 5 == 0 or broken and len(prompt) % 3 == 0:
                    raise ValueError(f"length {len(prompt)}")
                return f"{len(prompt)}"

            return reply

        return load_model

    # the first run saw the first documents only, and failed on more of them
    generate(prompts.filter("example_index % 2 = 0"), model(True), path, prompts_per_commit=1000)
    made = generate(prompts, model(False), path, attempts=3, prompts_per_commit=1000)
    return made.select("example_index", "predicted_text", "generation_error", F.col("attempts").cast("int").alias("attempts"))


def in_files(df: DataFrame, spread: list[str], label: str) -> DataFrame:
    """A stream of ``df``, written in four files in no order and read one file a batch."""
    path = staged_path(df.sparkSession, label)
    df.repartition(4, F.xxhash64(*spread)).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def accuracy_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies arrive as a stream and are joined to the stored examples; in the end those
    without a reply have failed."""
    events = table(spark, sf_dir, "events")
    stored, path = examples(events), staged_path(spark, "accuracy")
    replies = in_files(predictions(events), ["example_index"], "replies")
    accuracy_stream(replies, stored, ["run_id"], path, staged_path(spark, "stream")).awaitTermination()
    return final_summary(stored, path, ["run_id"])


_SUMMARY = """
  CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (correct) AS BIGINT) AS correct,
  round(count(*) FILTER (correct) / count(*), 4) AS accuracy,
  CAST(count(*) FILTER (tool_name_match) AS BIGINT) AS tool_name_match,
  round(count(*) FILTER (tool_name_match) / count(*), 4) AS tool_name_accuracy,
  CAST(count(*) FILTER (args_match) AS BIGINT) AS args_match,
  CAST(count(*) FILTER (false_positive) AS BIGINT) AS false_positives,
  CAST(count(*) FILTER (false_negative) AS BIGINT) AS false_negatives,
  round(count(*) FILTER (false_positive) / count(*), 4) AS false_positive_rate,
  round(count(*) FILTER (false_negative) / count(*), 4) AS false_negative_rate
FROM scored
"""

QUERIES = {
    "prediction_join": prediction_join,
    "expected_tool": expected_tool,
    "parse_tool_call": parse_tool_call,
    "args_match": args_match,
    "score_examples": score_examples,
    "result_rows": result_rows,
    "eval_summary": eval_summary,
    "eval_summary_total": eval_summary_total,
    "failure_count": failure_count,
    "failure_report": failure_report,
    "report_text": report_text,
    "evaluation_files": evaluation_files,
    "eval_limit": eval_limit,
    "running_accuracy": running_accuracy,
    "predict_hook": predict_hook,
    "predict_resume": predict_resume,
    "accuracy_stream": accuracy_live,
}

ORACLE = {
    "prediction_join": SQL + "SELECT example_index, predicted_text, generation_failed FROM joined",
    "expected_tool": """
        SELECT event_id,
          CASE WHEN event_type = 'view' THEN NULL WHEN event_id % 3 < 2 THEN event_type ELSE '' END AS name,
          CASE WHEN event_type = 'view' THEN NULL WHEN event_id % 3 < 2 THEN props ELSE '{}' END AS arguments
        FROM events""",
    "parse_tool_call": SQL + "SELECT example_index, predicted_name AS name, predicted_k AS k FROM calls",
    "args_match": SQL
    + """SELECT example_index, expected_k IS NULL OR coalesce(predicted_k, '') = expected_k AS args_match
         FROM calls""",
    "score_examples": SQL
    + """SELECT example_index, generation_failed, tool_name_match, args_match, false_positive,
                false_negative, correct FROM scored""",
    "result_rows": SQL
    + """SELECT example_index, input[1:500] AS input, expected_name, predicted_name, predicted_text, correct
         FROM scored""",
    "eval_summary": SQL + "SELECT run_id," + _SUMMARY + "GROUP BY run_id",
    "eval_summary_total": SQL + "SELECT" + _SUMMARY,
    "failure_count": SQL
    + "SELECT run_id, CAST(count(*) FILTER (NOT correct) AS BIGINT) AS failures FROM scored GROUP BY run_id",
    "failure_report": SQL
    + """SELECT example_index, input[1:200] AS input, expected_name, predicted_name,
                predicted_text[1:300] AS predicted_text
         FROM scored WHERE NOT correct ORDER BY example_index LIMIT 50""",
    "report_text": SQL
    + ", s AS (SELECT"
    + _SUMMARY
    + """), lines AS (
      SELECT 0 AS part, unnest([
          '# Evaluation Report' || chr(10), '**Model**: m', '**Dataset**: events', '**Format**: flat',
          '**Date**: 2024-01-01 00:00:00', '**Run ID**: r' || total, chr(10) || '## Summary' || chr(10),
          '| Metric | Value |', '|--------|-------|']) AS line,
        unnest(range(9)) AS item FROM s
      UNION ALL SELECT 1, unnest([
          '| total | ' || total || ' |', '| correct | ' || correct || ' |',
          '| accuracy | ' || printf('%.1f', accuracy * 100) || '% |',
          '| tool_name_match | ' || tool_name_match || ' |',
          '| tool_name_accuracy | ' || printf('%.1f', tool_name_accuracy * 100) || '% |',
          '| args_match | ' || args_match || ' |',
          '| false_positives | ' || false_positives || ' |',
          '| false_negatives | ' || false_negatives || ' |',
          '| false_positive_rate | ' || printf('%.1f', false_positive_rate * 100) || '% |',
          '| false_negative_rate | ' || printf('%.1f', false_negative_rate * 100) || '% |']),
        unnest(range(10)) FROM s
      UNION ALL SELECT 2, chr(10) || '## Failures' || chr(10), 0
      UNION ALL (SELECT 3, '### Example ' || example_index || chr(10) || '**Input**: ' || input[1:200] || chr(10) || chr(10)
          || '**Expected tool**: `' || coalesce('{"name":"' || expected_name || '","arguments":' || expected_arguments || '}', 'None')
          || '`' || chr(10) || chr(10) || '**Predicted tool**: `'
          || coalesce('{"name":"' || predicted_name || '","arguments":'
               || CASE WHEN json_type(body, '$.arguments') = 'VARCHAR' THEN json_extract_string(body, '$.arguments')
                       ELSE CAST(json_extract(body, '$.arguments') AS VARCHAR) END || '}', 'None')
          || '`' || chr(10) || chr(10) || '**Predicted text**: ' || predicted_text[1:300] || chr(10) || chr(10) || '---' || chr(10),
          example_index FROM scored WHERE NOT correct ORDER BY example_index LIMIT 50)
      UNION ALL SELECT 4, '*' || (total - correct - 50) || ' more failures not shown — see results.json*', 0
        FROM s WHERE total - correct > 50)
      SELECT CAST(part AS INTEGER) AS part, CAST(item AS BIGINT) AS item, line FROM lines""",
    "evaluation_files": """
        WITH answered AS (
          SELECT item_id AS example_index, item_id % 3 <> 0 AS correct,
                 CASE WHEN item_id % 3 = 0 THEN '<tool_call>{"name":"f"}</tool_call>' ELSE text END AS predicted_text
          FROM benchmark WHERE item_id % 5 <> 3)
        SELECT answered.*, 'm' AS model, 64 AS max_tokens, CAST(0 AS DOUBLE) AS temperature,
               CAST((SELECT count(*) FROM benchmark) AS BIGINT) AS raw_total,
               CAST((SELECT count(*) FROM answered) AS BIGINT) AS scored_total,
               CAST((SELECT count(*) FROM benchmark WHERE item_id % 5 = 3) AS BIGINT) AS skipped,
               CAST((SELECT count(*) FROM answered) AS BIGINT) AS total,
               CAST((SELECT count(*) FROM answered WHERE correct) AS BIGINT) AS total_correct
        FROM answered""",
    "eval_limit": SQL + "SELECT example_index, correct FROM scored WHERE example_index < 500",
    "running_accuracy": SQL
    + """SELECT user_id, example_index,
                round(avg(CAST(correct AS DOUBLE)) OVER (
                  PARTITION BY user_id ORDER BY example_index ROWS UNBOUNDED PRECEDING), 6) AS accuracy_so_far
         FROM scored""",
    "predict_resume": """
        SELECT doc_id AS example_index, CASE WHEN length(text) % 5 <> 0 THEN CAST(length(text) AS VARCHAR) END AS predicted_text,
               CASE WHEN length(text) % 5 = 0 THEN 'ValueError: length ' || length(text) END AS generation_error,
               CASE WHEN length(text) % 5 = 0 THEN 3 WHEN doc_id % 2 = 0 AND length(text) % 3 = 0 THEN 2 ELSE 1 END AS attempts
        FROM documents""",
    "predict_hook": "SELECT doc_id, 'echo' AS name, CAST(length(text) AS BIGINT) AS n FROM documents",
    "accuracy_stream": SQL + "SELECT run_id," + _SUMMARY + "GROUP BY run_id",
}
