"""Aggregates over scored examples and training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.operators.running import BLOCK_ROWS, running_sums

# The order and names of the published metrics.
SUMMARY_FIELDS = [
    "total",
    "correct",
    "accuracy",
    "tool_name_match",
    "tool_name_accuracy",
    "args_match",
    "false_positives",
    "false_negatives",
    "false_positive_rate",
    "false_negative_rate",
]

_COUNTED = {
    "correct": "correct",
    "tool_name_match": "tool_name_match",
    "args_match": "args_match",
    "false_positives": "false_positive",
    "false_negatives": "false_negative",
}

_RATES = {
    "accuracy": "correct",
    "tool_name_accuracy": "tool_name_match",
    "false_positive_rate": "false_positives",
    "false_negative_rate": "false_negatives",
}


def counters() -> list[Column]:
    """The counts of a summary, as plain partial aggregates."""
    return [F.count("*").alias("total")] + [
        F.count_if(F.col(flag)).alias(name) for name, flag in _COUNTED.items()
    ]


def with_rates(counts: DataFrame, by: list[str]) -> DataFrame:
    """Derive the rates, rounded to four places, from the counts."""
    rates = {
        name: F.round(F.col(count) / F.col("total"), 4) for name, count in _RATES.items()
    }
    return counts.withColumns(rates).select(*by, *SUMMARY_FIELDS)


def summarize(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Evaluation summary, one row per group; no row for no examples."""
    by = by or []
    counts = scored.groupBy(*by).agg(*counters()).filter(F.col("total") > 0)
    return with_rates(counts, by)


def split_counts(rows: DataFrame) -> DataFrame:
    """Training rows per split."""
    return rows.groupBy("split").agg(F.count("*").alias("examples"))


def failure_count(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    return scored.groupBy(*(by or [])).agg(F.count_if(~F.col("correct")).alias("failures"))


def running_accuracy(
    scored: DataFrame,
    by: list[str],
    index: str = "example_index",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Accuracy over the examples seen so far, per group in index order."""
    summed = running_sums(
        scored,
        by,
        index,
        {"correct_so_far": F.col("correct").cast("long"), "scored_so_far": F.lit(1)},
        block_rows,
    )
    return summed.withColumn("accuracy_so_far", F.col("correct_so_far") / F.col("scored_so_far"))
