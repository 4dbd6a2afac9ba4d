"""Formats whose rows hold a list of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake import schemas
from chatlake.formats.base import INDEX, JSON_PROBLEM, Format, column, empty, raw_text, tools_text
from chatlake.functions import jsonkinds as K
from chatlake.functions import messages as M
from chatlake.functions.jsontext import WHOLE
from chatlake.functions.template import CHATML, Template
from chatlake.operators import examples


class FlaggedMessages(Format):
    """Messages where ``train_on_turn`` names the turns to learn from.

    ``any_role`` also trains on flagged turns that the model did not write.
    """

    json_fields = (
        "messages:array<struct<role:string,content:string,train_on_turn:string,"
        "tool_calls:string>>,tools:string"
    )

    def __init__(self, name: str, any_role: bool = False):
        self.name = name
        self.any_role = any_role

    def read_json(self, rows: DataFrame) -> DataFrame:
        """Content may be a string or a list of blocks, a flag any value. One element that is no
        object leaves no list; such lines are read again to name it."""
        raw, flag = F.col("raw"), "train_on_turn"
        flags = F.exists("messages", lambda m: K.untrue_form(m.getField(flag))) & K.maybe_text(raw, flag)
        again = F.exists("messages", lambda m: K.unclear(m.getField("content"))) | flags
        whole = F.from_json(raw, "messages array<string>", WHOLE).getField("messages")

        def message(m: Column, i: Column) -> Column:
            own = F.try_element_at("_whole", i + 1)
            return m.withField("content", K.content(m.getField("content"), own)).withField(flag, K.truth(m.getField(flag), own, flag))

        lost = F.col("messages").isNull() & F.col("problem").isNull()
        return (
            rows.withColumn("_whole", F.when(again, whole))
            .withColumn("messages", F.transform("messages", message))
            .withColumn(JSON_PROBLEM, F.when(lost, K.list_problem(raw)))
            .drop("_whole")
        )

    def problem(self, rows: DataFrame) -> Column:
        messages, data_type = column(rows, "messages")
        if messages is None:
            return F.lit(M.NO_MESSAGES)
        if not isinstance(data_type, T.ArrayType):
            return F.lit(M.NO_LIST)
        return M.messages_problem(messages)

    def _messages(self, rows: DataFrame) -> Column:
        return M.normalize(*column(rows, "messages"))

    def _flags(self, messages: Column) -> Column:
        return messages

    def _prepared(self, rows: DataFrame, *extra: Column) -> DataFrame:
        return self.valid(rows).select(
            INDEX, self._messages(rows).alias("messages"), tools_text(rows).alias("_tools"), *extra
        )

    def _holds_messages(self, rows: DataFrame) -> bool:
        return isinstance(column(rows, "messages")[1], T.ArrayType)

    def convert_for_training(self, rows: DataFrame, template: Template = CHATML) -> DataFrame:
        if not self._holds_messages(rows):
            return empty(rows, schemas.TRAINING)
        prepared = self._prepared(rows).withColumn("messages", self._flags(F.col("messages")))
        made = examples.training_rows(prepared, template, F.col("_tools"), self.any_role)
        return made.select(INDEX, "turn_index", "prompt", "completion", "text")

    def convert_for_eval(self, rows: DataFrame, template: Template = CHATML) -> DataFrame:
        if not self._holds_messages(rows):
            return empty(rows, schemas.EVALUATION)
        prepared = self._prepared(rows, raw_text(rows).alias("input"))
        made = examples.evaluation_rows(prepared, template, F.col("_tools"))
        return made.select(INDEX, "prompt", "expected_text", "expected_tool", "input")


class ReplyMessages(FlaggedMessages):
    """Messages without flags: every model-written turn is trained on."""

    def _flags(self, messages: Column) -> Column:
        return M.mark_replies(messages)
