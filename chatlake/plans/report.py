"""The text report of an evaluation, as a frame of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.functions.text import percent
from chatlake.functions.toolcall import call_json
from chatlake.operators.metrics import SUMMARY_FIELDS
from chatlake.operators.scoring import cut

# Sizes and wording of the report.
MAX_FAILURES = 50
INPUT_CHARS = 200
TEXT_CHARS = 300
META_LABELS = {
    "model": "Model",
    "dataset": "Dataset",
    "format": "Format",
    "date": "Date",
    "run_id": "Run ID",
}
TITLE = "# Evaluation Report\n"
SUMMARY_TITLE = "\n## Summary\n"
TABLE_HEAD = ["| Metric | Value |", "|--------|-------|"]
FAILURES_TITLE = "\n## Failures\n"
NO_FAILURES = "No failures — perfect score! 🎉"
FAILURE = (
    "### Example %d\n**Input**: %s\n\n**Expected tool**: `%s`\n\n"
    "**Predicted tool**: `%s`\n\n**Predicted text**: %s\n\n---\n"
)
MORE = "*%d more failures not shown — see results.json*"


def first_failures(
    scored: DataFrame,
    limit: int | None = MAX_FAILURES,
    input_chars: int | None = INPUT_CHARS,
    text_chars: int | None = TEXT_CHARS,
) -> DataFrame:
    """The first ``limit`` failures in index order, with input and reply cut to
    so many characters. None means all, and whole texts.

    Failures sort before correct examples, so a top-k over both and a filter of
    its result score each example once; a filter in front would be pushed into
    the scoring and repeat it.
    """
    first = scored if limit is None else scored.orderBy("correct", "example_index").limit(limit)
    return first.filter(~F.col("correct")).select(
        "example_index",
        cut("input", input_chars),
        "expected_tool",
        "predicted_tool",
        cut("predicted_text", text_chars),
    )


def report(
    scored: DataFrame,
    summary: DataFrame,
    meta: DataFrame,
    limit: int | None = MAX_FAILURES,
    input_chars: int | None = INPUT_CHARS,
    text_chars: int | None = TEXT_CHARS,
) -> DataFrame:
    """Lines of the report (``part``, ``item``, ``line``); the limits are those
    of ``first_failures``.

    ``summary`` and ``meta`` have one row each; a summary without rows is that
    of an evaluation without examples.
    """

    def lines(source: DataFrame, part: int, values) -> DataFrame:
        return source.select(
            F.lit(part).alias("part"), F.posexplode(F.array(*values)).alias("item", "line")
        ).withColumn("item", F.col("item").cast("long"))

    labels = [
        F.concat(F.lit(f"**{label}**: "), F.col(name).cast("string")) for name, label in META_LABELS.items()
    ]
    head = lines(meta, 0, [F.lit(TITLE), *labels, F.lit(SUMMARY_TITLE), *map(F.lit, TABLE_HEAD)])

    def shown(name: str):
        value = F.col(name)
        is_rate = isinstance(summary.schema[name].dataType, T.DoubleType)
        return F.concat(
            F.lit(f"| {name} | "), percent(value) if is_rate else value.cast("string"), F.lit(" |")
        )

    table = lines(summary, 1, [shown(name) for name in SUMMARY_FIELDS])
    title = lines(meta, 2, [F.lit(FAILURES_TITLE)])

    def call(name: str):
        return F.coalesce(F.when(F.col(name).isNotNull(), call_json(F.col(name))), F.lit("None"))

    failures = first_failures(scored, limit, input_chars, text_chars).select(
        F.lit(3).alias("part"),
        F.col("example_index").alias("item"),
        F.format_string(
            FAILURE, "example_index", "input", call("expected_tool"), call("predicted_tool"), "predicted_text"
        ).alias("line"),
    )
    count = scored.agg(F.count_if(~F.col("correct")).alias("_n"))
    rest = F.lit(0) if limit is None else F.col("_n") - limit
    closing = count.select(
        F.lit(4).alias("part"),
        F.lit(0).cast("long").alias("item"),
        F.when(F.col("_n") == 0, F.lit(NO_FAILURES)).when(rest > 0, F.format_string(MORE, rest)).alias("line"),
    ).filter(F.col("line").isNotNull())
    return head.union(table).union(title).union(failures).union(closing)


def write_report(lines: DataFrame, path: str) -> None:
    """Write the report in order."""
    lines.orderBy("part", "item").select("line").coalesce(1).write.mode("overwrite").text(path)
