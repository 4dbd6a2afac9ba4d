"""Running values per key without one task per key.

A key may own a large part of all rows, so a window over the whole key would
put them into one task. The integer position of a row assigns it to a block of
bounded size; windows run inside blocks, and what the earlier blocks add up to
comes from a table with one row per block.

Rows are spread by one struct column ``_block`` of key and block number. It is
never null, so keys that are null survive the join, and both uses of the spread
rows (totals per block, and the rows themselves) read the same shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key in one task at most, since positions are unique in a key.
BLOCK_ROWS = 1 << 20


def spread_by_block(df: DataFrame, keys: list[str], position: str, block_rows: int) -> DataFrame:
    number = F.floor(F.col(position) / F.lit(block_rows)).cast("long")
    block = F.struct(*keys, number.alias("_number"))
    return df.withColumn("_block", block).repartition("_block")


def inside_block(position: str):
    """Window over the rows of a block up to the current one."""
    return (
        Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def earlier_blocks(keys: list[str]):
    """Window over the rows of earlier blocks in a per-block table with the keys
    and the ``_last`` position of each block."""
    return Window.partitionBy(*keys).orderBy("_last").rowsBetween(Window.unboundedPreceding, -1)


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys as columns of their own again."""
    return df.withColumns({key: F.col("_block").getField(key) for key in keys})


def running_sums(
    df: DataFrame,
    keys: list[str],
    position: str,
    values: dict[str, Column],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running sum of each of ``values`` per key in the order of ``position``.

    The result has the keys, the position and the sums.
    """
    narrow = df.select(*keys, position, *[value.alias(name) for name, value in values.items()])
    blocked = spread_by_block(narrow, keys, position, block_rows).drop(*keys)
    totals = blocked.groupBy("_block").agg(
        F.max(position).alias("_last"), *[F.sum(name).alias(f"_total_{name}") for name in values]
    )
    before = with_keys(totals, keys).select(
        "_block",
        *[
            F.coalesce(F.sum(f"_total_{name}").over(earlier_blocks(keys)), F.lit(0)).alias(f"_before_{name}")
            for name in values
        ],
    )
    return with_keys(blocked.join(before, "_block"), keys).select(
        *keys,
        position,
        *[
            (F.sum(name).over(inside_block(position)) + F.col(f"_before_{name}")).alias(name)
            for name in values
        ],
    )
