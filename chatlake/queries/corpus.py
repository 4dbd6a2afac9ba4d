"""Queries that prepare conversations, documents and flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.formats import load_format
from chatlake.formats.registry import FLAGGED_MESSAGES, FLAT_CALLS, REPLY_MESSAGES
from chatlake.functions import messages as M
from chatlake.functions.template import CHATML
from chatlake.operators import metrics
from chatlake.operators import turns as R
from chatlake.operators.ordering import assign_split, index_by_key
from chatlake.plans.dispatch import convert_all
from chatlake.queries.fixtures import table


def replies() -> Column:
    return M.is_reply(F.col("role"))


def flagged() -> Column:
    return (F.col("role") == "assistant") & (F.col("turn") % 4 == 1)


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def _with_bad_roles(turns: DataFrame) -> DataFrame:
    bad = (F.col("conv_id") % 10 == 7) & (F.col("turn") >= 1)
    return turns.withColumn(
        "role",
        F.when(bad & (F.col("turn") % 2 == 0), F.lit(None).cast("string"))
        .when(bad, F.lit("narrator"))
        .otherwise(F.col("role")),
    )


def conversation_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.assemble(_turns(spark, sf_dir))
    return rows.select(
        "conv_id",
        F.array_join("messages.role", ",").alias("roles"),
        F.array_join("messages.content", "|").alias("contents"),
        F.size("messages").cast("long").alias("n_turns"),
    )


def message_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of whole rows, with the rows that are dropped marked."""
    rows = R.assemble(_with_bad_roles(_turns(spark, sf_dir))).withColumnRenamed("conv_id", "example_index")
    checked = load_format(REPLY_MESSAGES).validate(rows)
    return checked.select(
        F.col("example_index").alias("conv_id"), "reason", F.col("reason").isNull().alias("kept")
    )


def message_validate_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reasons found without assembling conversations."""
    return R.invalid_conversations(_with_bad_roles(_turns(spark, sf_dir)))


def content_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as block lists, one block per line."""
    blocks = F.transform(
        F.split("text", "\n"), lambda t: F.struct(F.lit("text").alias("type"), t.alias("text"))
    )
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.array(F.struct(F.lit("user").alias("role"), blocks.alias("content"))).alias("messages"),
    )
    message = F.try_element_at(M.normalize(F.col("messages"), rows.schema["messages"].dataType), F.lit(1))
    return rows.select("doc_id", message.alias("m")).select(
        "doc_id", F.col("m.content").alias("content"), F.col("m.train_on_turn").alias("train_on_turn")
    )


def render_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.render_turns(_turns(spark, sf_dir))


def _training(spark: SparkSession, sf_dir: str, trainable) -> DataFrame:
    rows = R.training_rows(R.rendered_blocks(_turns(spark, sf_dir), trainable))
    return rows.select("conv_id", "turn_index", "prompt", "completion", "text")


def train_examples_all_assistant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir, replies())


def train_examples_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir, flagged())


def training_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: conversations to indexed, split training text."""
    rows = R.split_training_rows(_turns(spark, sf_dir), replies())
    return rows.select("example_index", "turn_index", "text", "split")


def example_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = index_by_key(_turns(spark, sf_dir).select("conv_id").distinct(), ["conv_id"])
    return assign_split(index).select("conv_id", "example_index", "split")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.split_counts(_turns(spark, sf_dir), replies())


def eval_examples_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir)
    return R.evaluation_prompts(R.rendered_blocks(turns, F.lit(False))).select(
        "conv_id", "reply_turn", "prompt"
    )


def eval_examples_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation examples of a message dataset, where a conversation is a row."""
    turns = _turns(spark, sf_dir)
    calls = F.when(
        replies(),
        F.array(
            F.struct(
                F.struct(
                    F.concat(F.lit("tool_"), F.col("turn").cast("string")).alias("name"),
                    F.lit('{"a": 1}').alias("arguments"),
                ).alias("function")
            )
        ),
    )
    rows = R.assemble(turns, extra={"tool_calls": calls}).withColumnRenamed("conv_id", "example_index")
    made = load_format(FLAGGED_MESSAGES).convert_for_eval(rows)
    return made.select(
        F.col("example_index").alias("conv_id"),
        "prompt",
        "expected_text",
        F.col("expected_tool.name").alias("expected_name"),
        F.col("expected_tool.arguments").alias("expected_arguments"),
    )


def eval_examples_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("example_index"),
        F.lit("Answer briefly.").alias("instructions"),
        F.when(F.col("item_id") % 2 == 0, F.lit("[]"))
        .otherwise(F.lit('[{"name":"search"}]'))
        .alias("tools"),
        F.when(F.col("item_id") % 5 != 3, F.col("text")).alias("input"),
        F.lit(None).cast("string").alias("output"),
    )
    made = load_format(FLAT_CALLS).convert_for_eval(rows)
    return made.select(
        F.col("example_index").alias("item_id"),
        "prompt",
        F.col("expected_tool").isNull().alias("no_tool"),
    )


def format_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets of different formats converted into one training set."""
    turns = _turns(spark, sf_dir)
    flag = {"train_on_turn": flagged()}

    def dataset(part: int, extra=None) -> DataFrame:
        own = turns.filter(F.col("conv_id") % 3 == part)
        return R.assemble(own, extra=extra).withColumnRenamed("conv_id", "example_index")

    flat = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("example_index"),
        F.lit("Answer briefly.").alias("instructions"),
        F.lit("[]").alias("tools"),
        F.col("text").alias("input"),
    )
    made = convert_all(
        {
            "flagged": (FLAGGED_MESSAGES, dataset(0, flag)),
            "replies": (REPLY_MESSAGES, dataset(1)),
            "plain": (FLAGGED_MESSAGES, dataset(2)),
            "flat": (FLAT_CALLS, flat),
        }
    )
    return made.select("dataset_id", F.col("example_index").alias("conv_id"), "turn_index", "text")


QUERIES = {
    "conversation_assemble": conversation_assemble,
    "message_validate": message_validate,
    "message_validate_turns": message_validate_turns,
    "content_normalize": content_normalize,
    "render_turns": render_turns,
    "train_examples_all_assistant": train_examples_all_assistant,
    "train_examples_flagged": train_examples_flagged,
    "training_splits": training_splits,
    "example_split": example_split,
    "split_counts": split_counts,
    "eval_examples_messages": eval_examples_messages,
    "eval_examples_rows": eval_examples_rows,
    "eval_examples_flat": eval_examples_flat,
    "format_union": format_union,
}

_RENDERED = """
WITH rendered AS (
  SELECT conv_id, turn, role, text AS content,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS turn_text
  FROM conversations),
texts AS (
  SELECT *, coalesce(string_agg(turn_text, '') OVER (
              PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS prompt
  FROM rendered)
"""

_INDEXED = (
    _RENDERED
    + """, ranked AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS example_index,
         count(*) OVER () AS total
  FROM (SELECT DISTINCT conv_id FROM conversations)),
indexed AS (
  SELECT conv_id, CAST(example_index AS BIGINT) AS example_index,
         CASE WHEN example_index * 10 < total * 8 THEN 'train'
              WHEN example_index * 10 < total * 9 THEN 'valid' ELSE 'test' END AS split
  FROM ranked)
"""
)

_BAD = """
WITH bad AS (
  SELECT conv_id, turn,
         CASE WHEN conv_id % 10 = 7 AND turn >= 1 THEN
           CASE WHEN turn % 2 = 0 THEN 'Message ' || turn || ' missing ''role'''
                ELSE 'Message ' || turn || ' has unsupported role: narrator' END END AS problem
  FROM conversations)
"""

_EXAMPLES = (
    "SELECT conv_id, CAST(turn AS INTEGER) AS turn_index, prompt, turn_text AS completion, "
    "prompt || turn_text AS text FROM texts WHERE role = 'assistant'"
)

_LAST = (
    ", last AS (SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id) "
)

ORACLE = {
    "conversation_assemble": """
        SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS roles,
               string_agg(text, '|' ORDER BY turn) AS contents, CAST(count(*) AS BIGINT) AS n_turns
        FROM conversations GROUP BY conv_id""",
    "message_validate": _BAD
    + """SELECT conv_id, arg_min(problem, turn) FILTER (problem IS NOT NULL) AS reason,
                count(problem) = 0 AS kept
         FROM bad GROUP BY conv_id""",
    "message_validate_turns": _BAD
    + """SELECT conv_id, arg_min(problem, turn) AS reason FROM bad
         WHERE problem IS NOT NULL GROUP BY conv_id""",
    "content_normalize": """
        SELECT doc_id, split_part(text, chr(10), 1) AS content, FALSE AS train_on_turn FROM documents""",
    "render_turns": _RENDERED + "SELECT conv_id, turn, turn_text FROM rendered",
    "train_examples_all_assistant": _RENDERED + _EXAMPLES,
    "train_examples_flagged": _RENDERED + _EXAMPLES + " AND turn % 4 = 1",
    "training_splits": _INDEXED
    + """SELECT example_index, CAST(turn AS INTEGER) AS turn_index, prompt || turn_text AS text, split
         FROM texts JOIN indexed USING (conv_id) WHERE role = 'assistant'""",
    "example_split": _INDEXED + "SELECT conv_id, example_index, split FROM indexed",
    "split_counts": _INDEXED
    + """SELECT split, CAST(count(*) AS BIGINT) AS examples
         FROM texts JOIN indexed USING (conv_id) WHERE role = 'assistant' GROUP BY split""",
    "eval_examples_messages": _RENDERED
    + _LAST
    + """SELECT conv_id, turn AS reply_turn, prompt || '<|im_start|>assistant' || chr(10) AS prompt
         FROM texts JOIN last USING (conv_id, turn)""",
    "eval_examples_rows": _RENDERED
    + _LAST
    + """, called AS (
           SELECT conv_id, turn, '<|im_start|>' || role || chr(10) || text
                  || CASE WHEN role = 'assistant' THEN
                       CASE WHEN text = '' THEN '' ELSE chr(10) END
                       || '<tool_call>' || chr(10) || '{"name":"tool_' || turn || '","arguments":{"a": 1}}'
                       || chr(10) || '</tool_call>' ELSE '' END
                  || '<|im_end|>' || chr(10) AS called_text
           FROM conversations),
         histories AS (
           SELECT conv_id, turn, coalesce(string_agg(called_text, '') OVER (
             PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history
           FROM called)
         SELECT conv_id, history || '<|im_start|>assistant' || chr(10) AS prompt,
                content AS expected_text, 'tool_' || turn AS expected_name, '{"a": 1}' AS expected_arguments
         FROM texts JOIN last USING (conv_id, turn) JOIN histories USING (conv_id, turn)""",
    "eval_examples_flat": """
        SELECT item_id,
               CASE WHEN item_id % 2 = 0 THEN '' ELSE '<|im_start|>system' || chr(10) || '# Tools' || chr(10) || chr(10)
                 || '<tools>' || chr(10) || '[{"name":"search"}]' || chr(10) || '</tools><|im_end|>' || chr(10) END
               || '<|im_start|>system' || chr(10) || 'Answer briefly.<|im_end|>' || chr(10)
               || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
               || '<|im_start|>assistant' || chr(10) AS prompt,
               TRUE AS no_tool
        FROM benchmark WHERE item_id % 5 <> 3""",
    "format_union": _RENDERED
    + """SELECT CASE conv_id % 3 WHEN 0 THEN 'flagged' ELSE 'replies' END AS dataset_id, conv_id,
                CAST(turn AS INTEGER) AS turn_index, prompt || turn_text AS text
         FROM texts
         WHERE role = 'assistant' AND ((conv_id % 3 = 0 AND turn % 4 = 1) OR conv_id % 3 = 1)""",
}
