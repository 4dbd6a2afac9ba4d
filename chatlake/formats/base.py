"""The interface of a dataset format."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake import schemas
from chatlake.functions.messages import json_text
from chatlake.functions.template import CHATML, Template

INDEX = "example_index"
# Reason that only the JSON of a row tells, such as a value of a wrong kind.
JSON_PROBLEM = "_json_problem"


class Format(ABC):
    """Turns raw rows of one dataset layout into training and evaluation rows.

    Raw rows carry an ``example_index`` beside the layout's own columns. Every
    method is a DataFrame transformation; a new layout is added by a subclass
    in the registry.
    """

    name: str
    trains: bool = True
    #: layout of a row in a JSON lines file, for ``sources.jsonl.parse``
    json_fields: str

    def read_json(self, rows: DataFrame) -> DataFrame:
        """Rows parsed by ``json_fields``, with their ``raw`` line, in the layout that the other
        methods take; JSON_PROBLEM names values of a wrong kind."""
        return rows

    @abstractmethod
    def problem(self, rows: DataFrame) -> Column:
        """Why a row is not valid, or null."""

    @abstractmethod
    def convert_for_training(self, rows: DataFrame, template: Template = CHATML) -> DataFrame:
        """Valid rows to ``schemas.TRAINING``."""

    @abstractmethod
    def convert_for_eval(self, rows: DataFrame, template: Template = CHATML) -> DataFrame:
        """Valid rows to ``schemas.EVALUATION``."""

    def validate(self, rows: DataFrame) -> DataFrame:
        """Rows with the ``reason`` they are rejected for, null for valid ones."""
        reason = self.problem(rows)
        if JSON_PROBLEM in rows.columns:
            reason = F.coalesce(F.col(JSON_PROBLEM), reason)
        return rows.withColumn("reason", reason)

    def valid(self, rows: DataFrame) -> DataFrame:
        return self.validate(rows).filter(F.col("reason").isNull()).drop("reason")

    def rejects(self, rows: DataFrame) -> DataFrame:
        """Index and reason of the rows that ``valid`` leaves out."""
        return self.validate(rows).filter(F.col("reason").isNotNull()).select(INDEX, "reason")


def column(rows: DataFrame, name: str) -> tuple[Column | None, T.DataType | None]:
    """A column and its type, or nothing when the layout has none."""
    if name not in rows.columns:
        return None, None
    return F.col(name), rows.schema[name].dataType


def tools_text(rows: DataFrame) -> Column:
    """The ``tools`` of a row as JSON text; null for none and for an empty list."""
    value, data_type = column(rows, "tools")
    if value is None:
        return F.lit(None).cast("string")
    text = json_text(value, data_type)
    return F.when(F.regexp_replace(text, r"\s", "") != "[]", text)


def raw_text(rows: DataFrame) -> Column:
    """The row as JSON text for reports: the original line where there is one."""
    if "raw" in rows.columns:
        return F.col("raw")
    return F.to_json(
        F.struct(*[c for c in rows.columns if c != INDEX]), {"ignoreNullFields": "false"}
    )


def empty(rows: DataFrame, schema: str) -> DataFrame:
    """No rows of ``schema``, without reading the input."""
    return rows.sparkSession.createDataFrame([], schema)
