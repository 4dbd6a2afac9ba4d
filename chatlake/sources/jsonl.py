"""JSON lines: scan in file order, count and parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake.formats.base import INDEX, Format
from chatlake.functions.jsontext import with_object
from chatlake.functions.text import strip
from chatlake.operators.ordering import sum_before
from chatlake.session import checkpointed, lookup, staged_path

NOT_AN_OBJECT = "not one JSON object"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(
        strip(F.col("value")).alias("raw"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    return lines.filter(F.col("raw") != "")


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """One row with the number of lines that are not blank."""
    return _lines(spark, path).agg(F.count("*").alias("lines"))


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Stripped lines as ``raw`` with a dense ``example_index`` in file order.

    Blank lines are skipped and take no index. The lines are staged once with
    the place they were read at, so that places and offsets always come from
    the same read.
    """
    staged = staged_path(spark, "lines")
    _lines(spark, path).withColumn("_place", F.monotonically_increasing_id()).write.parquet(staged)
    lines = spark.read.parquet(staged)
    blocks = lines.groupBy("_path", "_start").agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first")
    )
    # one row per file block, not per line
    offsets = blocks.select(
        "_path", "_start", (sum_before("_n", ["_path", "_start"]) - F.col("_first")).alias("_shift")
    )
    # measured and joined, but counted once
    offsets = checkpointed(offsets)
    return lines.join(lookup(offsets), ["_path", "_start"]).select(
        (F.col("_place") + F.col("_shift")).alias(INDEX), "raw"
    )


def parse(lines: DataFrame, fields: str) -> DataFrame:
    """Parse ``raw`` into the columns of ``fields`` (DDL ``name:type`` list).

    A line that is not one JSON object keeps its row and index, with
    ``problem`` set and all fields null, so that totals count it; the formats
    then reject it. A field of another type than wanted is null.
    """
    names = T._parse_datatype_string(f"struct<{fields}>").names
    parsed = with_object(lines, "_row", F.col("raw"), fields)
    return parsed.select(
        INDEX,
        "raw",
        F.when(F.col("_row").isNull(), F.lit(NOT_AN_OBJECT)).alias("problem"),
        *[F.col("_row").getField(n).alias(n) for n in names],
    )


def parse_format(lines: DataFrame, fmt: Format) -> DataFrame:
    """Parse lines into the layout of a format, which judges values by their JSON kind.

    The parsed rows are staged, since a filter on a reason would be pushed below the parsing and
    repeat it for every field that the reason depends on, and each use of the rows once more.
    """
    parsed = fmt.read_json(parse(lines, fmt.json_fields))
    staged = staged_path(lines.sparkSession, "parsed")
    parsed.write.parquet(staged)
    return lines.sparkSession.read.schema(parsed.schema).parquet(staged)
