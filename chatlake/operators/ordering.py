"""Dense example indexes, positional splits and index limits.

Splits and limits depend on the order of the rows, so a dense 0-based index is
needed. No function here sorts the rows into one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.session import checkpointed

# monotonically_increasing_id keeps the row number in a partition in its low 33 bits.
_ROW_BITS = 33

# The split boundaries, in tenths of the example count.
TRAIN_TENTHS = 8
VALID_TENTHS = 9


def index_by_key(keys: DataFrame, order: list[str], index: str = "example_index") -> DataFrame:
    """Number rows 0..n-1 in the order of ``order``, which must be unique.

    Rows are range partitioned, sorted inside partitions and checkpointed with
    their place in the partition; adding the count of all earlier partitions
    gives the index. The joined offsets have one row per partition.
    """
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ranged = (
        keys.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", place)
    )
    staged = checkpointed(ranged)
    part = F.shiftright("_place", _ROW_BITS)
    offsets = (
        staged.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", sum_before("_n", ["_part"]).alias("_offset"))
    )
    # at most one row per shuffle partition, whatever the data size
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            *keys.columns,
            (F.col("_offset") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)).alias(index),
        )
    )


def index_by_file(files: DataFrame, index: str = "example_index") -> DataFrame:
    """Number the rows of a Parquet scan by file path and position in the file.

    ``files`` must be the scan itself, before any filter. Rows are not
    shuffled. One offset per file is broadcast under a 64-bit hash of the path:
    16 bytes for each file, of which Spark's driver holds the path and status
    already. Should two paths share a hash, another seed is taken.
    """
    path = F.col("_metadata.file_path")
    counts = checkpointed(files.groupBy(path.alias("_path")).agg(F.count("*").alias("_n")))
    seed = 0
    while True:
        known = F.xxhash64(F.lit(seed), "_path")
        all_files, hashes = counts.agg(F.count("*"), F.count_distinct(known)).first()
        if hashes == all_files:
            break
        seed += 1
    offsets = counts.select(known.alias("_file"), sum_before("_n", ["_path"]).alias("_offset"))
    located = files.select("*", F.xxhash64(F.lit(seed), path).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return located.join(F.broadcast(offsets), "_file").select(
        *files.columns, (F.col("_offset") + F.col("_row")).alias(index)
    )


def sum_before(value: str, order: list[str]) -> Column:
    """Sum of all earlier rows. For offset tables with one row per file,
    partition or block only."""
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def split_of(index: Column, total: Column) -> Column:
    """train, valid or test by position. Integer arithmetic keeps the boundary
    the same in every engine."""
    return (
        F.when(index * 10 < total * TRAIN_TENTHS, F.lit("train"))
        .when(index * 10 < total * VALID_TENTHS, F.lit("valid"))
        .otherwise(F.lit("test"))
    )


def assign_split(indexed: DataFrame, total: int | None = None, index: str = "example_index") -> DataFrame:
    """Add the split of each row. ``total`` counts all indexed rows; it is
    measured here unless the caller knows it."""
    if total is None:
        total = indexed.count()
    return indexed.withColumn("split", split_of(F.col(index), F.lit(total)))


def first_examples(indexed: DataFrame, limit: int | None, index: str = "example_index") -> DataFrame:
    """The examples whose index is below ``limit``; zero and none mean all."""
    return indexed.filter(F.col(index) < limit) if limit else indexed
