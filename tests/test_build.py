"""Sources, incremental builds and inference."""

import pytest
from pyspark.sql import functions as F

from chatlake import session
from chatlake.formats.registry import REPLY_MESSAGES
from chatlake.inference import generate, predict, read_predictions
from chatlake.plans.build import Dataset, build_missing, inventory_digest, read_builds
from chatlake.sources import manifest, parquet
from chatlake.sources.sinks import write_splits

ROWS = "example_index long, messages array<struct<role:string,content:string>>"


def conversations(spark, n):
    return spark.createDataFrame([(i, [("user", f"q{i}"), ("assistant", f"a{i}")]) for i in range(n)], ROWS)


def test_builds_are_done_once(spark, tmp_path):
    out, log = str(tmp_path / "out"), str(tmp_path / "builds")
    first = [Dataset("a", REPLY_MESSAGES, conversations(spark, 10), "x")]
    assert build_missing(spark, first, out, log).count() == 1
    assert build_missing(spark, first, out, log).count() == 0
    more = first + [Dataset("b", REPLY_MESSAGES, conversations(spark, 20), "x")]
    assert [r.dataset_id for r in build_missing(spark, more, out, log).collect()] == ["b"]
    changed = [Dataset("a", REPLY_MESSAGES, conversations(spark, 11), "y")]
    assert build_missing(spark, changed, out, log).count() == 1
    assert read_builds(spark, log).count() == 3
    built = spark.read.parquet(out).groupBy("build_key").pivot("split").count()
    counts = sorted((r.train, r.valid, r.test) for r in built.collect())
    assert counts == [(8, 1, 1), (9, 1, 1), (16, 2, 2)]


def test_split_files_hold_text_only(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb", "train", 1), ("c", "test", 2)], "text string, split string, n int")
    write_splits(rows, str(tmp_path / "s"))
    assert [r.value for r in spark.read.text(str(tmp_path / "s" / "split=train")).collect()] == ['{"text":"a\\nb"}']


def test_manifest(spark, tmp_path):
    for name, size in (("a.parquet", 3), ("b.parquet", 4), ("c.txt", 1), ("d.parquet", 2)):
        (tmp_path / name).write_bytes(b"x" * size)
    files = manifest.inventory(spark, str(tmp_path))
    wanted = spark.createDataFrame([("a.parquet", 3), ("b.parquet", 5), ("e.parquet", 1)], "file string, size long")
    got = {r.file: r.status for r in manifest.check(files, wanted).collect()}
    assert got == {"a.parquet": "ok", "b.parquet": "wrong size", "d.parquet": "unexpected", "e.parquet": "missing"}
    before = inventory_digest(files).first().digest
    assert before == inventory_digest(files.repartition(3)).first().digest
    assert before != inventory_digest(files.filter("file <> 'a.parquet'")).first().digest


def test_raw_json_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows.select(parquet.raw_json(rows.columns).alias("j")).first().j == '{"a":1,"b":null}'


def test_failed_generation_gives_null(spark):
    def failing_model():
        def generate(prompt, max_tokens, temperature):
            if prompt == "bad":
                raise RuntimeError("no reply")
            return f"{prompt}:{max_tokens}:{temperature}"

        return generate

    rows = spark.createDataFrame([("x",), ("bad",), ("y",)], "prompt string")
    got = {r.prompt: r.predicted_text for r in predict(rows, failing_model, partitions=2).collect()}
    assert got == {"x": "x:512:0.0", "bad": None, "y": "y:512:0.0"}


def test_a_broken_run_goes_on(spark, tmp_path):
    out, log = str(tmp_path / "replies"), tmp_path / "asked"
    log.mkdir()
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(40)] + [(None, "no index"), (10**9, "far")], "example_index long, prompt string")

    def model(run, fails):
        def load_model():
            def reply(prompt, max_tokens, temperature):
                with open(log / f"{run}-{prompt}", "a") as f:
                    f.write("x")
                if prompt in fails:
                    raise RuntimeError(prompt)
                return f"{run}:{prompt}"

            return reply

        return load_model

    class Broken(Exception):
        pass

    writes = []
    real = type(rows.write).parquet

    def parquet(self, path, *more, **options):
        writes.append(path)
        if len(writes) == 3:
            raise Broken
        return real(self, path, *more, **options)

    type(rows.write).parquet = parquet
    try:
        with pytest.raises(Broken):
            generate(rows.filter("example_index < 100"), model(1, {"p3"}), out, prompts_per_commit=10)
    finally:
        type(rows.write).parquet = real
    first = {r.example_index: r.predicted_text for r in read_predictions(spark, out).collect()}
    assert set(first) == set(range(20))
    done = {r.example_index: r for r in generate(rows, model(2, {"p3", "p5", "p39"}), out, attempts=2, prompts_per_commit=10).collect()}
    assert set(done) == {*range(40), 10**9}
    assert {i for i, r in done.items() if r.predicted_text is None} == {3, 39}
    assert (done[3].generation_error, done[3].attempts, done[39].attempts, done[7].attempts) == ("RuntimeError: p3", 2, 2, 1)
    assert all(done[i].predicted_text == t for i, t in first.items() if t is not None)
    assert not list(log.glob("2-p7")) and list(log.glob("2-p25")) and not list(log.glob("*-no index"))
    asked = len(list(log.glob("3-*")))
    assert generate(rows, model(3, set()), out, attempts=2).count() == 41 and len(list(log.glob("3-*"))) == asked == 0


def test_lookup_is_broadcast_only_when_small(spark):
    rows = spark.range(1000).select(F.col("id"), F.repeat(F.lit("x"), 100).alias("t"))
    big = rows.join(session.lookup(rows, limit_bytes=1000).alias("l"), "id")
    small = rows.join(session.lookup(rows, limit_bytes=10**6).alias("l"), "id")
    assert session.estimated_bytes(rows) == 1000 * (32 + 8 + 100)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()


def test_arrays_and_binary_count_in_the_estimate(spark):
    rows = spark.createDataFrame([([(1, "ab"), (2, None)], bytearray(5), None)], "a array<struct<x:int,t:string>>, b binary, c array<long>")
    assert session.estimated_bytes(rows) == 32 + (8 + 2 * (8 + 8) + 2) + 5 + 8


def test_staging_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.staging_root(Session())
