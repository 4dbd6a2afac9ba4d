"""A flat, evaluation-only format: instructions, tools, input and the call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake import schemas
from chatlake.formats.base import INDEX, JSON_PROBLEM, Format, column, empty, raw_text, tools_text
from chatlake.functions import jsonkinds as K
from chatlake.functions import messages as M
from chatlake.functions.template import CHATML, Template

REQUIRED = ["instructions", "tools", "input"]
# The reasons for which a row is not valid.
NO_FIELD = "Missing required field: '{}'"
NO_LIST = "'tools' must be a list"
NO_TEXT = "'input' must be a string"


class FlatCalls(Format):
    trains = False
    json_fields = "instructions:string,tools:string,input:string,output:string,tool_calls:string"

    def __init__(self, name: str):
        self.name = name

    def read_json(self, rows: DataFrame) -> DataFrame:
        """Every field is read as text; only a list may be ``tools`` and only a string ``input``."""
        raw, tools, text = F.col("raw"), F.col("tools"), F.col("input")
        reason = F.when(F.col("problem").isNotNull(), F.lit(None).cast("string"))
        for field in REQUIRED:
            reason = reason.when(F.col(field).isNull() & ~K.has_key(raw, field), F.lit(NO_FIELD.format(field)))
        a_list = F.when(K.maybe_text(raw, "tools"), K.kind(tools, raw, "tools") == "array").otherwise(F.lit(True))
        a_list = F.coalesce(F.startswith(F.ltrim(tools), F.lit("[")) & a_list, F.lit(False))
        a_text = F.coalesce(K.kind(text, raw, "input") == "string", F.lit(False))
        return rows.withColumn(JSON_PROBLEM, reason.when(~a_list, F.lit(NO_LIST)).when(~a_text, F.lit(NO_TEXT)))

    def problem(self, rows: DataFrame) -> Column:
        reason = None
        for field in REQUIRED:
            value, _ = column(rows, field)
            absent = F.lit(True) if value is None else value.isNull()
            text = F.lit(NO_FIELD.format(field))
            reason = F.when(absent, text) if reason is None else reason.when(absent, text)
        tools, tools_type = column(rows, "tools")
        if isinstance(tools_type, T.StringType):
            reason = reason.when(~F.startswith(F.ltrim(tools), F.lit("[")), F.lit(NO_LIST))
        elif tools is not None and not isinstance(tools_type, T.ArrayType):
            reason = reason.when(F.lit(True), F.lit(NO_LIST))
        _, input_type = column(rows, "input")
        if input_type is not None and not isinstance(input_type, T.StringType):
            reason = reason.when(F.lit(True), F.lit(NO_TEXT))
        return reason

    def convert_for_training(self, rows: DataFrame, template: Template = CHATML) -> DataFrame:
        return empty(rows, schemas.TRAINING)

    def convert_for_eval(self, rows: DataFrame, template: Template = CHATML) -> DataFrame:
        if any(field not in rows.columns for field in REQUIRED):
            return empty(rows, schemas.EVALUATION)
        output, _ = column(rows, "output")
        calls = M.tool_calls(*column(rows, "tool_calls"))
        prompt = flat_prompt(
            F.col("instructions"), F.col("input"), template, tools_text(rows)
        )
        return self.valid(rows).select(
            INDEX,
            prompt.alias("prompt"),
            (F.lit("") if output is None else output).alias("expected_text"),
            F.try_element_at(calls, F.lit(1)).cast(schemas.TOOL_CALL).alias("expected_tool"),
            raw_text(rows).alias("input"),
        )


def flat_prompt(instructions: Column, text: Column, template: Template, tools: Column) -> Column:
    """The system and the user turn of a flat row, and the start of a reply."""
    return F.concat(
        template.tools_header(tools),
        template.turn(F.lit("system"), instructions),
        template.turn(F.lit("user"), text),
        F.lit(template.generation),
    )
