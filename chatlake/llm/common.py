"""Small helpers shared by the operators on document text."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.session import remove_tree, staged_path

# Code points that separate words, as a character class for Java regular expressions.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\f\r"

# Bytes of rows that Python gets at once inside ``small_batches``.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back."""
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *done: DataFrame) -> None:
    """Delete staged tables that are read no more, and let Spark delete the files of shuffles that
    nothing refers to, which it does when the driver collects garbage."""
    for path in {f.rsplit("/", 1)[0] for df in done for f in df.inputFiles()}:
        remove_tree(spark, path)
    # Python's references are dropped with the next call into the JVM, whose cleaner works beside
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands its rows to Python in batches that end with the row that reaches
    BATCH_BYTES. By default they end at 10,000 rows or 64 MiB, which the JVM holds twice beside its
    heap and the Python worker once more. Rows and results are the same."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def runs(sizes: list[int], budget: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to ``budget`` at most, one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > budget:
            yield start, i
            start, total = i, 0
        total += size
    if sizes:
        yield start, len(sizes)
