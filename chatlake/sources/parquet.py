"""Parquet datasets: scan with an index in file order, and raw JSON rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.operators.ordering import index_by_file


def scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All rows of a Parquet dataset with their dense ``example_index``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return index_by_file(reader.parquet(path))


def raw_json(columns: list[str]) -> Column:
    """A row as one JSON object; null fields are written, not dropped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_raw_lines(rows: DataFrame, path: str) -> None:
    """Write one JSON object per row. Files keep the order of the partitions."""
    rows.select(raw_json(rows.columns).alias("value")).write.mode("overwrite").text(path)
