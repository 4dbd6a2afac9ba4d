"""Session helpers: where to stage data, and when a join side may be broadcast."""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup is broadcast only when its measured size stays below this.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

# Widths used for the estimate of fixed-size fields and per-row overhead.
_FIELD_BYTES = 8
_ROW_BYTES = 32


# Rows of a few numbers that make a file of their own when a frame is stored.
PART_ROWS = 64 * 1024

_folders: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    It is the one named in ``spark.checkpoint.dir``. Where that is unset a
    folder below the warehouse is taken, but only on a local master: nothing
    tells whether executors on other machines could read it.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _own_folder(spark, spark.conf.get("spark.sql.warehouse.dir"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def _own_folder(spark: SparkSession, root: str) -> str:
    """A folder of this application below ``root``, which its file system
    removes when the application ends."""
    key = f"{spark.sparkContext.applicationId} {root}"
    if key not in _folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex}")
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _folders[key] = path.toString()
    return _folders[key]


def staged_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for a table that lives as long as the application."""
    return f"{_own_folder(spark, staging_root(spark))}/{label}-{uuid.uuid4().hex}"


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a staged folder through the file system that holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so values such as partition ids stay fixed
    when an executor is lost and its tasks run again."""
    staging_root(df.sparkSession)
    return df.checkpoint(eager=True)


def few(df: DataFrame) -> DataFrame:
    """``checkpointed`` for a frame known to stay small: one file in place of one per shuffle partition.

    A file costs a task, and on a local file system processes of the executor (Hadoop runs ``chmod``
    for each). Only the rows meet in one task; what makes them stays distributed."""
    return checkpointed(df.repartition(1))


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``checkpointed`` for a frame of ``rows`` narrow rows at most, or that makes so many of them: in files of
    PART_ROWS where these are few beside the partitions of a shuffle. Rows are dealt in turn, not by key."""
    parts = max(1, math.ceil(rows / PART_ROWS))
    fewer = 2 * parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(df.repartition(parts) if fewer else df)


def _width(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda v: _width(v, kind.elementType).cast("long"))
        return F.lit(_FIELD_BYTES) + F.coalesce(F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0))
    if isinstance(kind, T.StructType):
        return reduce(Column.__add__, [_width(value.getField(f.name), f.dataType) for f in kind.fields], F.lit(_FIELD_BYTES))
    return F.lit(_FIELD_BYTES)


def estimated_bytes(df: DataFrame) -> int:
    """Size of a lookup frame, measured with one distributed aggregate."""
    width = F.lit(_ROW_BYTES)
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def lookup(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` hinted for broadcast when it is small enough, else unhinted so the
    join shuffles (with adaptive skew splitting)."""
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df
