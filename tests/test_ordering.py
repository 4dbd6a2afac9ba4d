"""Dense indexes, splits and limits."""

import pytest
from pyspark.sql import functions as F

from chatlake.operators.ordering import assign_split, first_examples, index_by_key
from chatlake.sources import parquet


def test_index_by_key_is_dense_and_ordered(spark):
    keys = spark.range(5000).select((F.col("id") * 37 % 5003).alias("a"), F.hex("id").alias("b"))
    got = index_by_key(keys.repartition(13), ["a", "b"]).orderBy("a", "b").collect()
    assert [r.example_index for r in got] == list(range(5000))


def test_index_by_key_with_few_rows(spark):
    assert index_by_key(spark.range(1), ["id"]).collect()[0].example_index == 0
    assert index_by_key(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("files", [1, 5])
def test_index_by_file_follows_files(spark, tmp_path, files):
    path = str(tmp_path / f"d{files}")
    spark.range(1000).repartitionByRange(files, "id").sortWithinPartitions("id").write.parquet(path)
    for width in ("128MB", "2KB"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", width)
        try:
            rows = parquet.scan(spark, path).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(r.example_index for r in rows) == list(range(1000))
        assert all(r.id == r.example_index for r in rows)


@pytest.mark.parametrize("total", [1, 9, 10, 11, 100, 399])
def test_split_boundaries(spark, total):
    rows = assign_split(spark.range(total).withColumnRenamed("id", "example_index")).collect()
    for row in rows:
        share = row.example_index / total
        assert row.split == ("train" if share < 0.8 else "valid" if share < 0.9 else "test")


def test_limit_counts_indexes(spark):
    rows = spark.createDataFrame([(0,), (3,), (7,)], "example_index long")
    assert first_examples(rows, 4).count() == 2
    assert first_examples(rows, 0).count() == 3
    assert first_examples(rows, None).count() == 3


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_index_does_not_gather_the_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).withColumn("text", F.lit("x")).write.parquet(path)
    indexed = parquet.scan(spark, path)
    # the one-partition window sees the per-file counts only, and rows stay where they are read
    exchanges = [l for l in plan(indexed).splitlines() if "Exchange" in l]
    assert sum("SinglePartition" in l for l in exchanges) == 1
    assert sum("hashpartitioning" in l for l in exchanges) <= 1
    assert "BroadcastHashJoin" in plan(indexed)
