"""A whole evaluation: examples, predictions, scores, summary and report."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.formats import load_format
from chatlake.functions.template import CHATML, Template
from chatlake.operators.metrics import summarize
from chatlake.operators.ordering import first_examples
from chatlake.inference import MAX_TOKENS, TEMPERATURE
from chatlake.operators.scoring import INPUT_CHARS as RESULT_CHARS
from chatlake.operators.scoring import attach_predictions, results, score
from chatlake.plans.report import MAX_FAILURES, report, write_report
from chatlake.sources.sinks import write_results, write_summary


def evaluation_set(
    rows: DataFrame, format_name: str, template: Template = CHATML, limit: int | None = None
) -> DataFrame:
    """Evaluation examples of indexed raw rows. The limit counts raw rows."""
    return load_format(format_name).convert_for_eval(first_examples(rows, limit), template)


def run_metadata(
    rows: DataFrame, scored: DataFrame, model: str, dataset: str, format_name: str, run_id: str,
    limit: int | None = None, max_tokens: int = MAX_TOKENS, temperature: float = TEMPERATURE,
) -> DataFrame:
    """One row about the run: generation settings, raw rows within the limit,
    scored and skipped ones."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    raw = first_examples(rows, limit).agg(F.count("*").alias("raw_total")).withColumn("_k", F.lit(1))
    done = scored.agg(F.count("*").alias("scored_total")).withColumn("_k", F.lit(1))
    return raw.join(done, "_k").select(
        F.lit(model).alias("model"),
        F.lit(dataset).alias("dataset"),
        F.lit(format_name).alias("format"),
        F.lit(date).alias("date"),
        F.lit(run_id).alias("run_id"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(temperature).alias("temperature"),
        "raw_total",
        "scored_total",
        (F.col("raw_total") - F.col("scored_total")).alias("skipped"),
    )


def evaluate(
    rows: DataFrame,
    predictions: DataFrame,
    output: str,
    *,
    model: str,
    dataset: str,
    format_name: str,
    run_id: str,
    template: Template = CHATML,
    limit: int | None = None,
    max_tokens: int = MAX_TOKENS,
    temperature: float = TEMPERATURE,
    input_chars: int | None = RESULT_CHARS,
    failures: int | None = MAX_FAILURES,
) -> DataFrame:
    """Score predictions for a dataset and write results, summary and report.

    The scored table is written once; summary and report are read from it.
    ``max_tokens`` and ``temperature`` are those the predictions were made with;
    ``input_chars`` cuts the inputs in the results and ``failures`` the number
    of failures in the report (none: whole). Returns the summary.
    """
    spark = rows.sparkSession
    examples = evaluation_set(rows, format_name, template, limit)
    score(attach_predictions(examples, predictions)).write.mode("overwrite").parquet(f"{output}/scored")
    scored = spark.read.parquet(f"{output}/scored")
    summary = summarize(scored)
    meta = run_metadata(rows, scored, model, dataset, format_name, run_id, limit, max_tokens, temperature)
    write_results(results(scored, input_chars=input_chars), f"{output}/results")
    write_summary(summary, meta, f"{output}/summary")
    write_report(report(scored, summary, meta, failures), f"{output}/report")
    return summary
