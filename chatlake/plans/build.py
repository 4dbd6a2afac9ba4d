"""Building training splits, once per combination of inputs."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatlake.formats import load_format
from chatlake.formats.base import INDEX
from chatlake.functions.template import CHATML, Template
from chatlake.functions.text import composite_key, short_hash
from chatlake.operators.ordering import TRAIN_TENTHS, VALID_TENTHS, assign_split
from chatlake.session import lookup
from chatlake.sources.parquet import raw_json

BUILDS = "build_key string, attempt string, dataset_id string, format string, template string"
BUILT = f"{INDEX} long, turn_index int, text string, build_key string, attempt string, split string"
SPLIT_RULE = f"{TRAIN_TENTHS}-{VALID_TENTHS}"


def training_splits(rows: DataFrame, format_name: str, template: Template = CHATML) -> DataFrame:
    """Training rows with their split. ``rows`` holds all indexed raw rows, as
    the scans and ``jsonl.parse`` give them; rows that cannot be used keep their
    index and count in the total."""
    total = rows.count()
    made = load_format(format_name).convert_for_training(rows, template)
    return assign_split(made, total)


def inventory_digest(files: DataFrame) -> DataFrame:
    """One row whose ``digest`` changes when a file is added, removed or resized."""
    total = F.coalesce(F.sum(F.xxhash64("file", "size").cast("decimal(38,0)")), F.lit(0))
    return files.agg(
        short_hash(F.concat_ws(":", F.count("*").cast("string"), total.cast("string"))).alias("digest")
    )


def content_digest(rows: DataFrame, *by: str) -> DataFrame:
    """``digest`` and ``rows`` (their number) of all rows, or of each group: a 128-bit hash that does not
    depend on the order or division of the rows, and changes with any value in them. Rows that hold
    their index make it depend on the order of the file too. One scan, no row is moved."""
    hashed = F.md5(raw_json(rows.columns))

    def half(start: int) -> Column:
        return F.sum(F.conv(F.substring(hashed, start, 16), 16, 10).cast("decimal(28,0)"))

    def text(total: Column) -> Column:
        low = F.expr("cast('18446744073709551616' as decimal(20,0))")
        return F.lpad(F.lower(F.conv((F.coalesce(total, F.lit(0)) % low).cast("string"), 10, 16)), 16, "0")

    sums = rows.groupBy(*by).agg(F.count("*").alias("rows"), half(1).alias("_a"), half(17).alias("_b"))
    return sums.select(*by, F.concat_ws("-", F.col("rows").cast("string"), F.concat(text(F.col("_a")), text(F.col("_b")))).alias("digest"), "rows")


def build_key(dataset_id: Column, format_name: Column, template_key: Column, digest: Column) -> Column:
    """Key of a build: everything that changes its output."""
    return composite_key(
        short_hash(dataset_id),
        template_key,
        short_hash(F.concat_ws("|", format_name, digest, F.lit(SPLIT_RULE))),
    )


def data_key(dataset_id: Column, template_key: Column) -> Column:
    """Key of a prepared dataset: dataset and template."""
    return composite_key(short_hash(dataset_id), template_key)


def adapter_key(model: Column, dataset_id: Column, template_key: Column) -> Column:
    """Key of a training run: model, dataset and template."""
    return composite_key(model, short_hash(dataset_id), template_key)


def evaluation_key(model: Column, dataset_id: Column, run_id: Column) -> Column:
    """Key of an evaluation: model, dataset and run."""
    return composite_key(model, short_hash(dataset_id), run_id)


def pending(requested: DataFrame, built: DataFrame) -> DataFrame:
    """Requests whose key has not been built yet."""
    return requested.join(built.select("build_key").distinct(), "build_key", "left_anti")


@dataclass(frozen=True)
class Dataset:
    """A dataset to build: its indexed raw rows and a digest of them."""

    dataset_id: str
    format_name: str
    rows: DataFrame
    digest: str

    @staticmethod
    def of(dataset_id: str, format_name: str, rows: DataFrame) -> Dataset:
        """A dataset known by its content, so rows that change in place are built again."""
        return Dataset(dataset_id, format_name, rows, content_digest(rows).first()["digest"])


def read_builds(spark: SparkSession, manifest: str) -> DataFrame:
    """Finished builds, one row per key; none when nothing was built yet. Where two writers
    finished the same build, one of the two whole attempts counts for everyone."""
    try:
        published = spark.read.schema(BUILDS).parquet(manifest)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BUILDS)
    rest = F.struct("attempt", "dataset_id", "format", "template")
    return published.groupBy("build_key").agg(F.min(rest).alias("_b")).select("build_key", "_b.*")


def read_built(spark: SparkSession, output: str, manifest: str) -> DataFrame:
    """Rows of all finished builds with the build they belong to. Attempts that are not published,
    because they still run or were killed, are not seen."""
    builds = read_builds(spark, manifest)
    try:
        rows = spark.read.schema(BUILT).parquet(output)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], BUILT)
    return rows.join(lookup(builds), ["build_key", "attempt"])


def build_missing(
    spark: SparkSession,
    datasets: list[Dataset],
    output: str,
    manifest: str,
    template: Template = CHATML,
) -> DataFrame:
    """Write the training splits of all datasets not built before.

    Every request is known by its whole key, and each build goes to a folder of its own
    attempt. It is published by one record in the manifest after all its rows are there, so a build cut
    short is never seen and is simply done again, and two writers do not disturb each other. Read
    the rows with ``read_built``. Returns the requests that were built now.
    """
    names = [(i, d.dataset_id, d.format_name, template.name, d.digest) for i, d in enumerate(datasets)]
    requested = spark.createDataFrame(names, "at int, dataset_id string, format string, template string, digest string")
    keyed = requested.withColumn("build_key", build_key(F.col("dataset_id"), F.col("format"), template.key(), F.col("digest")))
    todo = pending(keyed, read_builds(spark, manifest)).groupBy("build_key").agg(F.min("at").alias("at"))
    # one row per request, a list the caller passed in; equal requests are one
    done = []
    for row in sorted(todo.collect(), key=lambda r: r.at):
        dataset, attempt = datasets[row.at], f"a{uuid.uuid4().hex}"
        made = training_splits(dataset.rows, dataset.format_name, template).select(INDEX, "turn_index", "text", "split")
        made.write.partitionBy("split").parquet(f"{output}/build_key={row.build_key}/attempt={attempt}")
        done.append((row.build_key, attempt, dataset.dataset_id, dataset.format_name, template.name))
        # a folder per record, as jobs that write to one folder at once delete each other's files
        record = spark.createDataFrame(done[-1:], BUILDS).drop("attempt").coalesce(1)
        record.write.parquet(f"{manifest}/attempt={attempt}")
    return spark.createDataFrame(done, BUILDS)


def remove_unpublished(spark: SparkSession, output: str, manifest: str, older_than_seconds: float) -> int:
    """Delete attempts that no record names and that began before the given time, which must be longer
    than any build takes. Returns how many there were."""
    known = {(r.build_key, r.attempt) for r in read_builds(spark, manifest).select("build_key", "attempt").collect()}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{output}/build_key=*/attempt=*")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for status in system.globStatus(path) or []:
        folder = status.getPath()
        key, attempt = (p.getName().split("=", 1)[1] for p in (folder.getParent(), folder))
        if (key, attempt) not in known and status.getModificationTime() / 1000 < time.time() - older_than_seconds:
            removed += bool(system.delete(folder, True))
    return removed
