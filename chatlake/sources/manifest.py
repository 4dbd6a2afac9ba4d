"""Checks of input files against a manifest of expected sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def inventory(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below ``path``, named by their path from there, and their size.
    Their content is not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = system.makeQualified(hadoop).toUri().getPath().rstrip("/") + "/"
    # paths are listed with scheme and authority in more than one spelling
    below = F.substring_index("path", root, -1) if root != "/" else F.parse_url("path", F.lit("PATH"))
    return files.select(below.alias("file"), F.col("length").alias("size"))


def check(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare an inventory with a manifest (``file``, ``size``), both ways."""
    found = actual.select("file", F.col("size").alias("actual_size"))
    wanted = expected.select("file", F.col("size").alias("expected_size"))
    return found.join(wanted, "file", "full_outer").withColumn(
        "status",
        F.when(F.col("actual_size").isNull(), F.lit("missing"))
        .when(F.col("expected_size").isNull(), F.lit("unexpected"))
        .when(F.col("actual_size") != F.col("expected_size"), F.lit("wrong size"))
        .otherwise(F.lit("ok")),
    )
