"""Builds are seen whole or not at all, under the key of their own request; files keep the order."""

import glob
import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from chatlake.formats.registry import FLAGGED_MESSAGES, REPLY_MESSAGES
from chatlake.plans import build
from chatlake.plans.build import Dataset, build_missing, content_digest, read_built, read_builds, remove_unpublished
from chatlake.sources import jsonl
from chatlake.sources.sinks import SPLITS, write_splits

ROWS = "example_index long, messages array<struct<role:string,content:string,train_on_turn:boolean>>"


def conversations(spark, n, mark="a"):
    return spark.createDataFrame([(i, [("user", f"q{i}", False), ("assistant", f"{mark}{i}", True)]) for i in range(n)], ROWS)


def texts(spark, out, log):
    """Last words of the rows of each build, by format and number of rows."""
    rows = read_built(spark, out, log).select("build_key", "format", "example_index", "text").collect()
    found = {}
    for r in rows:
        found.setdefault((r.build_key, r.format), []).append((r.example_index, r.text.split("\n")[-2].removesuffix("<|im_end|>")))
    return {k: [t for _, t in sorted(v)] for k, v in found.items()}


def test_each_request_gets_its_own_rows(spark, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    old, new = conversations(spark, 5, "old"), conversations(spark, 6, "new")
    one = Dataset("d", REPLY_MESSAGES, old, "1")
    assert build_missing(spark, [one], out, log).count() == 1
    done = build_missing(spark, [Dataset("d", REPLY_MESSAGES, new, "2"), one, Dataset("d", FLAGGED_MESSAGES, new, "2"), Dataset("d", REPLY_MESSAGES, new, "2")], out, log)
    assert done.count() == 2
    assert sorted((f, t) for (_, f), t in texts(spark, out, log).items()) == sorted(
        [(REPLY_MESSAGES, [f"old{i}" for i in range(5)]), (REPLY_MESSAGES, [f"new{i}" for i in range(6)]), (FLAGGED_MESSAGES, [f"new{i}" for i in range(6)])]
    )
    assert build_missing(spark, [one], out, log).count() == 0


def test_a_killed_build_is_never_seen(spark, tmp_path, monkeypatch):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    broken = conversations(spark, 20).repartition(4).withColumn("messages", F.when(F.col("example_index") < 19, F.col("messages")).otherwise(F.raise_error(F.lit("gone"))))
    monkeypatch.setattr(build, "training_splits", lambda rows, *_: build.assign_split(rows.selectExpr("example_index", "0 AS turn_index", "to_json(messages) AS text"), 20))
    with pytest.raises(Exception, match="gone"):
        build_missing(spark, [Dataset("d", REPLY_MESSAGES, broken, "1")], out, log)
    monkeypatch.undo()
    assert read_built(spark, out, log).count() == 0 and read_builds(spark, log).count() == 0
    # rows all there, but the record is not
    whole = Dataset("d", REPLY_MESSAGES, conversations(spark, 20), "1")
    real = spark.createDataFrame

    def fails(data, schema=None, **more):
        if schema == build.BUILDS and data:
            raise RuntimeError("killed before publishing")
        return real(data, schema, **more)

    monkeypatch.setattr(spark, "createDataFrame", fails)
    with pytest.raises(RuntimeError):
        build_missing(spark, [whole], out, log)
    monkeypatch.undo()
    assert glob.glob(f"{out}/build_key=*/attempt=*/split=train/*.parquet")
    assert read_built(spark, out, log).count() == 0
    assert build_missing(spark, [whole], out, log).count() == 1
    assert read_built(spark, out, log).count() == 20
    before = len(glob.glob(f"{out}/build_key=*/attempt=*"))
    assert remove_unpublished(spark, out, log, older_than_seconds=3600) == 0
    assert remove_unpublished(spark, out, log, older_than_seconds=-1) == before - 1
    assert read_built(spark, out, log).count() == 20


def test_two_writers_at_once(spark, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    wanted = [Dataset("d", REPLY_MESSAGES, conversations(spark, 30), "1"), Dataset("e", REPLY_MESSAGES, conversations(spark, 7), "1")]
    errors = []

    def write():
        try:
            build_missing(spark, wanted, out, log)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert read_builds(spark, log).count() == 2
    assert read_built(spark, out, log).count() == 37


def test_digest_follows_the_content_only(spark):
    rows = spark.createDataFrame([(i, f"t{i % 3}", None if i % 4 else 1.5) for i in range(50)], "i int, t string, x double")
    first = content_digest(rows).first()
    assert first.rows == 50
    assert content_digest(rows.repartition(7).orderBy(F.rand(3))).first() == first
    others = [rows.where("i <> 3"), rows.union(rows.where("i = 3")), rows.withColumn("t", F.when(F.col("i") == 3, "t9").otherwise(F.col("t"))), rows.withColumn("x", F.coalesce("x", F.lit(0.0)))]
    swapped = rows.withColumn("i", F.when(F.col("i") == 3, 4).when(F.col("i") == 4, 3).otherwise(F.col("i")))
    found = {content_digest(o).first().digest for o in [*others, swapped]} | {first.digest}
    assert len(found) == 6
    assert content_digest(rows.limit(0)).first().digest == "0-" + "0" * 32
    by = {r.t: r.digest for r in content_digest(rows, "t").collect()}
    assert by == {t: content_digest(rows.where(F.col("t") == t)).first().digest for t in ("t0", "t1", "t2")}


def test_a_file_of_equal_size_is_another_dataset(spark, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    for mark in ("a", "b"):
        assert build_missing(spark, [Dataset.of("d", REPLY_MESSAGES, conversations(spark, 9, mark))], out, log).count() == 1
    assert sorted(t[0] for t in texts(spark, out, log).values()) == ["a0", "b0"]


@pytest.mark.parametrize("per_file", [1, 7, 1000])
def test_files_of_a_split_keep_the_order(spark, tmp_path, per_file):
    rng = random.Random(per_file)
    rows = [(i, t, f"{i}:{t}\n", SPLITS[min(2, i // 20)]) for i in range(55) if i % 5 for t in range(i % 4)]
    made = spark.createDataFrame(rng.sample(rows, len(rows)), "example_index long, turn_index int, text string, split string").repartition(6)
    write_splits(made, str(tmp_path / "s"), per_file)
    for split in SPLITS:
        lines = [line for f in sorted(glob.glob(str(tmp_path / "s" / f"split={split}" / "part-*"))) for line in open(f)]
        assert [json.loads(line)["text"] for line in lines] == [r[2] for r in rows if r[3] == split]
        again = jsonl.parse(jsonl.scan(spark, str(tmp_path / "s" / f"split={split}")), "text:string").orderBy("example_index")
        assert [r.text for r in again.collect()] == [r[2] for r in rows if r[3] == split]
    longest = max(sum(1 for _ in open(f)) for f in glob.glob(str(tmp_path / "s" / "split=*" / "part-*")))
    assert longest <= 3 * per_file
