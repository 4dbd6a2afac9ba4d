"""One key with a third of all rows gives the same results as plain windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatlake.operators.losslog import early_stop
from chatlake.operators.metrics import running_accuracy


def test_running_accuracy_of_a_hot_group(spark):
    run = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 != 1, (F.col("id") % 11).cast("string"))
    rows = spark.range(6000).select(
        run.alias("run"), F.col("id").alias("example_index"), (F.xxhash64("id") % 3 == 0).alias("correct")
    )
    window = Window.partitionBy("run").orderBy("example_index").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.select("run", "example_index", F.avg(F.col("correct").cast("double")).over(window).alias("a"))
    made = running_accuracy(rows, ["run"], block_rows=100).select("run", "example_index", F.col("accuracy_so_far").alias("a"))
    want = {(r.run, r.example_index): round(r.a, 9) for r in plain.collect()}
    # rows without a run are a group of their own and stay
    assert {(r.run, r.example_index): round(r.a, 9) for r in made.collect()} == want and len(want) == 6000


def test_early_stop_of_a_hot_run(spark):
    run = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string"))
    rows = spark.range(6000).select(
        run.alias("run_id"), F.col("id").alias("line_no"), F.col("id").alias("iter"),
        (F.abs(F.xxhash64("id") % 1000) / 10.0 - F.col("id") / 100.0).alias("val_loss"),
    )
    for patience in (2, 40):
        split = {tuple(r) for r in early_stop(rows, patience, block_rows=64).collect()}
        whole = {tuple(r) for r in early_stop(rows, patience).collect()}
        assert split == whole and len(split) == 51
