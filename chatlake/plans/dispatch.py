"""Choosing the format of each dataset and converting several datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlake.formats import list_formats, load_format
from chatlake.functions.template import CHATML, Template
from chatlake.functions.text import short_hash
from chatlake.session import lookup


def resolve_formats(requests: DataFrame, remembered: DataFrame) -> DataFrame:
    """Format of each requested dataset.

    ``requests`` has ``dataset_id`` and a nullable ``explicit_format``,
    ``remembered`` the ``dataset_hash`` and ``format`` of earlier runs. The
    explicit value wins; ``problem`` tells when no supported format is known.
    """
    supported = list_formats()
    known = remembered.select("dataset_hash", F.col("format").alias("_remembered"))
    names = F.lit(", ".join(supported))
    return (
        requests.withColumn("dataset_hash", short_hash(F.col("dataset_id")))
        .join(lookup(known), "dataset_hash", "left")
        .withColumn("format", F.coalesce("explicit_format", "_remembered"))
        .withColumn(
            "problem",
            F.when(
                F.col("format").isNull(),
                F.concat(F.lit("No format given or remembered. Supported formats: "), names),
            ).when(
                ~F.col("format").isin(supported),
                F.concat(
                    F.lit("Unknown dataset format: '"), "format", F.lit("'. Supported formats: "), names
                ),
            ),
        )
        .select("dataset_id", "dataset_hash", "format", "problem")
    )


def remember(resolved: DataFrame, remembered: DataFrame) -> DataFrame:
    """The remembered formats after a run: new ones replace old ones."""
    fresh = resolved.filter(F.col("problem").isNull()).select("dataset_hash", "format").distinct()
    kept = remembered.select("dataset_hash", "format").join(fresh, "dataset_hash", "left_anti")
    return kept.unionByName(fresh)


def convert_all(
    datasets: dict[str, tuple[str, DataFrame]], template: Template = CHATML, training: bool = True
) -> DataFrame:
    """Convert datasets (id → format name and raw rows) into one frame.

    Datasets whose format does not train contribute nothing to training and
    are not read for it.
    """
    parts = []
    for dataset, (format_name, rows) in datasets.items():
        fmt = load_format(format_name)
        convert = fmt.convert_for_training if training else fmt.convert_for_eval
        parts.append(convert(rows, template).withColumn("dataset_id", F.lit(dataset)))
    return reduce(DataFrame.unionByName, parts)
