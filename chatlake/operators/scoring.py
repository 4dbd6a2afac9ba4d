"""Joining predictions to evaluation examples and scoring them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import toolcall as C

INPUT_CHARS = 500


def attach_predictions(
    examples: DataFrame, predictions: DataFrame, on: list[str] | None = None
) -> DataFrame:
    """Examples with their ``predicted_text``. A missing or null prediction is
    a failed generation: it is scored as an empty text and flagged. Of several
    predictions for an example the least text counts, so none is scored twice."""
    keys = on or ["example_index"]
    replies = predictions.groupBy(*keys).agg(F.min("predicted_text").alias("_reply"))
    return (
        examples.join(replies, keys, "left")
        .withColumn("generation_failed", F.col("_reply").isNull())
        .withColumn("predicted_text", F.coalesce("_reply", F.lit("")))
        .drop("_reply")
    )


def score(examples: DataFrame) -> DataFrame:
    """Score ``predicted_text`` against ``expected_tool``.

    Adds ``predicted_tool``, ``tool_name_match``, ``args_match``,
    ``false_positive``, ``false_negative`` and ``correct``.
    """
    calls = ("predicted_tool", "expected_tool")
    matched = C.with_tool_call(examples).withColumns(
        {
            "tool_name_match": C.name_match(*calls),
            "false_positive": C.false_positive(*calls),
            "false_negative": C.false_negative(*calls),
        }
    )

    def compared(call: str) -> Column:
        # arguments are parsed only where they decide
        return F.expr(f"CASE WHEN tool_name_match AND expected_tool IS NOT NULL THEN {call}.arguments END")

    parsed = C.with_arguments(
        matched, {"_predicted": compared("predicted_tool"), "_expected": compared("expected_tool")}
    )
    args_match = F.col("tool_name_match") & C.arguments_match("_predicted", "_expected")
    return parsed.select(*matched.columns, args_match.alias("args_match")).withColumn(
        "correct", F.expr("tool_name_match AND args_match AND NOT false_positive")
    )


def cut(column: str, chars: int | None) -> Column:
    """The first ``chars`` characters, or the whole text for none."""
    return (F.col(column) if chars is None else F.substring(column, 1, chars)).alias(column)


def results(scored: DataFrame, by: list[str] | None = None, input_chars: int | None = INPUT_CHARS) -> DataFrame:
    """The result rows of an evaluation, with the input cut to ``input_chars``
    (none: whole)."""
    return scored.select(
        *(by or []),
        "example_index",
        cut("input", input_chars),
        "expected_tool",
        "expected_text",
        F.struct(
            "tool_name_match",
            "args_match",
            "false_positive",
            "false_negative",
            "correct",
            "predicted_tool",
            "predicted_text",
        ).alias("score"),
        "generation_failed",
    )
