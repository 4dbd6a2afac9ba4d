"""Live evaluation metrics while replies arrive.

Each micro-batch is joined to the part of the stored examples whose index lies
in the batch's range, which Parquet statistics prune when the examples are
stored in the order of their index. Counts are kept in two slots, and so are the indexes
answered, as one bitmap per 2^15 indexes: a repeated batch gives the same state, and
nothing piles up from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chatlake.operators.metrics import counters, with_rates
from chatlake.operators.scoring import attach_predictions, score
from chatlake.session import lookup

INDEX = "example_index"
BITMAPS = "block long, bits binary"


def _slot(path: str, batch: int) -> str:
    return f"{path}/slot_{batch % 2}"


def _bits(path: str, batch: int) -> str:
    return f"{path}/answered_{batch % 2}"


def _place() -> tuple[Column, Column]:
    """Block of an index and its place in the block's bitmap; the functions count from one."""
    return F.bitmap_bucket_number(F.col(INDEX) + 1), F.bitmap_bit_position(F.col(INDEX) + 1)


def _marked(indexes: DataFrame) -> DataFrame:
    block, at = _place()
    return indexes.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(at).alias("bits"))


def _without(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows whose index is not marked."""
    block, at = _place()
    known = lookup(bitmaps.select(F.col("block").alias("_block"), "bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(_byte, cast(_at % 8 AS int)) & 1") == 1
    joined = rows.join(known, block == F.col("_block"), "left").withColumns({"_byte": byte, "_at": at})
    return joined.filter(~F.coalesce(marked, F.lit(False))).select(*rows.columns)


def _names(frame: DataFrame, by: list[str]) -> list[str]:
    return [c for c in frame.columns if c not in by and c != "batch_id"]


def accuracy_stream(
    replies: DataFrame, stored: DataFrame, by: list[str], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start counting a stream of replies (``example_index``, ``predicted_text``)
    to ``stored`` examples, per group.

    A null reply is a failed generation. The first reply to an example counts,
    within one batch that of the least text; replies to no example are ignored.
    ``trigger`` holds arguments of the stream's trigger; by default what is
    available is worked off.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{path}/replies_{batch_id % 2}"
        batch.filter(F.col(INDEX) >= 0).groupBy(INDEX).agg(F.min("predicted_text").alias("predicted_text")).write.mode("overwrite").parquet(own)
        new = spark.read.schema(f"{INDEX} long, predicted_text string").parquet(own)
        low, high = new.agg(F.min(INDEX), F.max(INDEX)).first()
        inside = F.col(INDEX).between(F.lit(low), F.lit(high))
        marks = _marked(new)
        if batch_id:
            earlier = spark.read.schema(BITMAPS).parquet(_bits(path, batch_id - 1))
            marks = earlier.unionByName(marks).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
            new = _without(new, earlier)
        marks.write.mode("overwrite").parquet(_bits(path, batch_id))
        scored = score(new.withColumn("predicted_text", F.coalesce("predicted_text", F.lit(""))).join(stored.filter(inside), INDEX))
        counts = scored.groupBy(*by).agg(*counters())
        if batch_id:
            before = spark.read.schema(T.StructType(counts.schema.fields)).parquet(_slot(path, batch_id - 1))
            counts = _added(before.unionByName(counts), by)
        # last, so that whoever sees the counts of a batch finds its bitmaps
        counts.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(_slot(path, batch_id))

    return (
        replies.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _added(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in _names(counts, by)])


def _newest(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    slots = spark.read.parquet(f"{path}/slot_*")
    return slots, slots.agg(F.max("batch_id")).first()[0]


def answered(spark: SparkSession, path: str) -> DataFrame:
    """Bitmaps (``block``, ``bits``) of the indexes with a reply so far."""
    newest = _newest(spark, path)[1]
    return spark.read.schema(BITMAPS).parquet(_bits(path, newest)) if newest is not None else spark.createDataFrame([], BITMAPS)


def _counts(spark: SparkSession, path: str) -> DataFrame:
    slots, newest = _newest(spark, path)
    return slots.filter(F.col("batch_id") == newest).drop("batch_id")


def read_summary(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The newest summary of every group."""
    return with_rates(_counts(spark, path), by)


def pending(stored: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Examples without a reply so far, per group."""
    left = _without(stored, answered(stored.sparkSession, path))
    return left.groupBy(*by).agg(F.count("*").alias("pending"))


def final_summary(stored: DataFrame, path: str, by: list[str]) -> DataFrame:
    """The summary when no more replies come: examples without one failed."""
    spark = stored.sparkSession
    left = _without(stored, answered(spark, path))
    none = spark.createDataFrame([], f"{INDEX} long, predicted_text string")
    missed = score(attach_predictions(left, none)).groupBy(*by).agg(*counters())
    return with_rates(_added(_counts(spark, path).unionByName(missed), by), by)
