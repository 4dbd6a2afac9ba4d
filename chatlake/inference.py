"""Running a user's model over evaluation prompts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.session import remove_tree, staged_path

# Generation defaults, greedy decoding.
MAX_TOKENS = 512
TEMPERATURE = 0.0

Generate = Callable[..., str]


REPLY = "struct<text:string,error:string>"
COMMITTED = "example_index long, predicted_text string, generation_error string"
# Prompts whose replies are stored together, the most parts of consecutive indexes that a run is
# divided into, and the most jobs that work them off.
PROMPTS_PER_COMMIT, MOST_COMMITS, MOST_JOBS = 100_000, 1000, 16


def predict(
    examples: DataFrame,
    load_model: Callable[[], Generate],
    max_tokens: int = MAX_TOKENS,
    temperature: float = TEMPERATURE,
    batch_size: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``predicted_text`` and ``generation_error`` for each ``prompt``.

    ``load_model`` runs once per Python worker and returns a function called as
    ``generate(prompt, max_tokens=..., temperature=...)``. A prompt on which it
    raises gets a null text, which scores as an empty reply, and the error's text. ``partitions``
    spreads the prompts evenly when the input has few or uneven partitions.
    """

    def make_predict():
        generate = load_model()

        def one(prompt: str) -> tuple[str | None, str | None]:
            try:
                return generate(prompt, max_tokens=max_tokens, temperature=temperature), None
            except Exception as error:
                return None, f"{type(error).__name__}: {error}"

        def batch(prompts: np.ndarray) -> dict[str, np.ndarray]:
            made = [one(p) for p in prompts]
            return {
                "text": np.array([m[0] for m in made], dtype=object),
                "error": np.array([m[1] for m in made], dtype=object),
            }

        return batch

    kind = T._parse_datatype_string(REPLY)
    reply = predict_batch_udf(make_predict, return_type=kind, batch_size=batch_size)
    spread = examples if partitions is None else examples.repartition(partitions)
    return (
        spread.withColumn("_reply", reply(F.col("prompt")))
        .withColumns({"predicted_text": F.col("_reply.text"), "generation_error": F.col("_reply.error")})
        .drop("_reply")
    )


def read_predictions(spark: SparkSession, output: str) -> DataFrame:
    """Replies stored by ``generate``: ``example_index``, ``predicted_text`` (null if every attempt
    failed), ``generation_error`` (of a failed one, if all are) and ``attempts``. Where several writers
    made a reply, that of the least text counts."""
    try:
        stored = spark.read.schema(COMMITTED).parquet(f"{output}/part_*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], COMMITTED)
    reply = F.min("predicted_text")
    return stored.groupBy("example_index").agg(
        reply.alias("predicted_text"),
        F.when(reply.isNull(), F.min("generation_error")).alias("generation_error"),
        F.count("*").alias("attempts"),
    )


def generate(
    examples: DataFrame,
    load_model: Callable[[], Generate],
    output: str,
    attempts: int = 1,
    prompts_per_commit: int = PROMPTS_PER_COMMIT,
    **options,
) -> DataFrame:
    """Replies to all ``examples`` (``example_index``, ``prompt``), stored below ``output`` as they are made.

    The prompts are worked off in parts of consecutive indexes, a job for each of them or, where they
    are many, for some that follow each other. A task takes about ``prompts_per_commit`` prompts at
    most and stores their replies when it ends, so a job that breaks off leaves those of its
    finished tasks; a round has MOST_COMMITS such tasks or as many as there are cores. A run that broke off goes on when called again: only prompts
    without a stored reply, and failed ones with fewer than ``attempts`` attempts, are given to the
    model. Nothing stored is changed, so rows that a broken job left are used, and two runs at once
    only do work twice. ``options`` are those of ``predict``. Examples without an index are left out.

    What is left is looked up once a round and staged by job, so that no job reads the prompts of another.
    """
    spark = examples.sparkSession
    known = examples.filter(F.col("example_index").isNotNull()).select("example_index", "prompt")
    spread = options.pop("partitions", None) or spark.sparkContext.defaultParallelism
    while True:
        stored = read_predictions(spark, output)
        settled = stored.filter(F.col("predicted_text").isNotNull() | (F.col("attempts") >= attempts))
        left = known.join(settled.select("example_index"), "example_index", "left_anti")
        low, high, n = left.agg(F.min("example_index"), F.max("example_index"), F.count("*")).first()
        if not n:
            return stored
        width = max(prompts_per_commit, -(-(high - low + 1) // MOST_COMMITS))
        together = max(prompts_per_commit, -(-n // MOST_COMMITS))
        part = F.floor((F.col("example_index") - low) / width)
        parts = sorted(left.groupBy(part.alias("part")).count().collect())
        each = -(-len(parts) // MOST_JOBS)
        jobs = [parts[i : i + each] for i in range(0, len(parts), each)]
        begins = F.array(*[F.lit(job[0]["part"]) for job in jobs])
        staged = staged_path(spark, "prompts")
        # as many cells as keep all cores busy and hold a part each
        cells = max(-(-spread // len(jobs)), -(-n // (len(jobs) * together)))
        placed = left.withColumn("_job", F.size(F.filter(begins, lambda b: b <= part)) - 1)
        placed = placed.repartition("_job", F.pmod(F.xxhash64("example_index"), F.lit(cells)))
        placed.write.partitionBy("_job").format("parquet").save(staged)
        for at, job in enumerate(jobs):
            prompts = spark.read.schema(left.schema).parquet(f"{staged}/_job={at}")
            tasks = max(spread, -(-sum(p["count"] for p in job) // together))
            made = predict(prompts, load_model, partitions=tasks, **options)
            made = made.select("example_index", "predicted_text", "generation_error")
            # under this version a task's file is in place when the task ends
            keeping = made.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            keeping.parquet(f"{output}/part_{uuid.uuid4().hex}")
        remove_tree(spark, staged)
