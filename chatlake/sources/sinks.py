"""Writers for training splits and evaluation results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.formats.base import INDEX

# The splits in order.
SPLITS = ["train", "valid", "test"]


# Examples whose training rows share a file.
EXAMPLES_PER_FILE = 100_000


def write_splits(rows: DataFrame, path: str, examples_per_file: int = EXAMPLES_PER_FILE) -> None:
    """Training text as JSON lines ``{"text": ...}`` in a folder per split.

    Rows with an ``example_index`` are written in its order, then by turn: the files of a split, by
    name, give the lines in the order of the dataset. The index is dense, so a row's file follows from it
    and nothing is sampled or sorted across files. Other rows are written as they come.
    """
    if INDEX in rows.columns:
        last = rows.agg(F.max(INDEX)).first()[0] or 0
        order = ["split", INDEX, *[c for c in ("turn_index",) if c in rows.columns]]
        file = F.floor(F.col(INDEX) / examples_per_file).cast("int")
        dealt = rows.select("text", *order).repartitionById(last // examples_per_file + 1, file)
        # the order begins with the split, so the writer adds no sort of its own
        rows = dealt.sortWithinPartitions(*order)
    rows.select("text", "split").write.mode("overwrite").partitionBy("split").json(path)


def write_results(results: DataFrame, path: str) -> None:
    """All scored examples as JSON lines."""
    results.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_summary(summary: DataFrame, meta: DataFrame, path: str) -> None:
    """One JSON object with the run's ``meta`` and ``summary``, a row each."""
    left = meta.select(F.struct("*").alias("meta"))
    right = summary.select(F.struct("*").alias("summary"))
    left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one", "left").drop(
        "_one"
    ).coalesce(1).write.mode("overwrite").json(path)
