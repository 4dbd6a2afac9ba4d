"""Live accuracy over replies that repeat, come late, or belong to no example."""

import glob
import json
import os
import random

from pyspark.sql import functions as F

from chatlake.operators.metrics import summarize
from chatlake.operators.scoring import attach_predictions, score
from chatlake.streaming import accuracy

REPLY = "example_index long, predicted_text string"


def examples(spark, n, far):
    rows = [(f"r{i % 3}", i * far, ("f", '{"k":%d}' % i)) for i in range(n)]
    return spark.createDataFrame(rows, "run_id string, example_index long, expected_tool struct<name:string,arguments:string>")


def reply(i, k):
    return '<tool_call>{"name":"f","arguments":{"k":%d}}</tool_call>' % k if i % 4 else "none"


def run(spark, tmp_path, stored, batches):
    source, path = tmp_path / "replies", str(tmp_path / "state")
    source.mkdir()
    for n, batch in enumerate(batches):
        file = source / f"{n:03}.json"
        file.write_text("\n".join(json.dumps({"example_index": i, "predicted_text": t}) for i, t in batch))
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))  # files are read in the order of their time
    stream = spark.readStream.schema(REPLY).option("maxFilesPerTrigger", 1).json(str(source))
    accuracy.accuracy_stream(stream, stored, ["run_id"], path, str(tmp_path / "checkpoint")).awaitTermination()
    return path


def test_first_reply_counts_and_nothing_piles_up(spark, tmp_path):
    rng = random.Random(5)
    far = 1499  # so that indexes lie in several bitmaps
    stored = examples(spark, 90, far)
    batches, first = [], {}
    for b in range(6):
        batch = [(i * far, reply(i, i + rng.randrange(2))) for i in rng.sample(range(100), 25)]
        batch += [(i * far, None) for i in rng.sample(range(90), 2)] + [(7, "no example"), (None, "x"), (-3, "y")]
        batches.append(batch)
        least = {}
        for i, t in batch:
            if i not in least or least[i] is None or t is not None and t < least[i]:
                least[i] = t
        for i, t in least.items():
            first.setdefault(i, t)
    path = run(spark, tmp_path, stored, batches)
    told = spark.createDataFrame([(i, t) for i, t in first.items() if i is not None], REPLY)
    known = score(attach_predictions(stored, told))
    seen = known.join(told.select("example_index"), "example_index", "left_semi")
    assert sorted(accuracy.read_summary(spark, path, ["run_id"]).collect()) == sorted(summarize(seen, ["run_id"]).collect())
    assert sorted(accuracy.final_summary(stored, path, ["run_id"]).collect()) == sorted(summarize(known, ["run_id"]).collect())
    left = {r.run_id: r.pending for r in accuracy.pending(stored, path, ["run_id"]).collect()}
    want = stored.join(told, "example_index", "left_anti").groupBy("run_id").agg(F.count("*").alias("n")).collect()
    assert left == {r.run_id: r.n for r in want}
    assert len(glob.glob(f"{path}/*")) == 6  # two slots each of replies, bitmaps and counts
    blocks = accuracy.answered(spark, path).select("block", F.bitmap_count("bits").alias("n")).collect()
    assert len(blocks) > 3 and sum(r.n for r in blocks) == len([i for i in first if i is not None and i >= 0])


def test_marks_at_the_ends_of_blocks(spark):
    marked = [0, 1, 7, 8, 32766, 32767, 32768, 65535, 65536, 10**12]
    rows = spark.createDataFrame([(i,) for i in marked], "example_index long")
    every = spark.createDataFrame([(i + d,) for i in marked for d in (-1, 0, 1) if i + d >= 0], "example_index long").distinct()
    left = {r.example_index for r in accuracy._without(every, accuracy._marked(rows)).collect()}
    assert left == {i + d for i in marked for d in (-1, 0, 1) if i + d >= 0} - set(marked)
