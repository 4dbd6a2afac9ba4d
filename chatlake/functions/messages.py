"""Column expressions over arrays of chat messages.

The input may hold messages in several typed layouts (text or block content,
wrapped or bare tool calls, arguments as text or struct). The schema decides at
plan time which expression is built, so no row pays for the other layouts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatlake import schemas
from chatlake.functions.jsontext import WHOLE

# The roles a message may have, and those written by the model.
SUPPORTED_ROLES = ["system", "user", "assistant", "tool", "model"]
REPLY_ROLES = ["assistant", "model"]

_JSON_CALLS = (
    "array<struct<function:struct<name:string,arguments:string>,name:string,arguments:string>>"
)


def is_reply(role: Column) -> Column:
    return F.coalesce(role.isin(REPLY_ROLES), F.lit(False))


def content_text(content: Column | None, data_type: T.DataType | None) -> Column:
    """Plain text of a message: text as is, the first block of a block list,
    and an empty text for everything else."""
    if isinstance(data_type, T.StringType):
        return F.coalesce(content, F.lit(""))
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
        if "text" in data_type.elementType.names:
            return F.coalesce(F.try_element_at(content, F.lit(1)).getField("text"), F.lit(""))
    return F.lit("")


def json_text(value: Column, data_type: T.DataType) -> Column:
    """JSON text of a value; text is taken to be JSON already. Fields that are
    null in a struct are left out, since a merged Parquet schema invents them."""
    if isinstance(data_type, T.StringType):
        return value
    return F.to_json(value)


def _call(call: Column, data_type: T.StructType) -> Column:
    """One call; a ``function`` wrapper is opened where it is present."""

    def fields(source: Column, kind: T.StructType) -> Column:
        def part(field: str, default: str) -> Column:
            if field not in kind.names:
                return F.lit(default)
            return F.coalesce(json_text(source.getField(field), kind[field].dataType), F.lit(default))

        return F.struct(
            part("name", "").alias("name"), part("arguments", "{}").alias("arguments")
        ).cast(schemas.TOOL_CALL)

    bare = fields(call, data_type)
    if "function" not in data_type.names:
        return bare
    inner = data_type["function"].dataType
    if not isinstance(inner, T.StructType):
        return bare
    function = call.getField("function")
    return F.when(function.isNotNull(), fields(function, inner)).otherwise(bare)


def tool_calls(value: Column | None, data_type: T.DataType | None) -> Column:
    """Calls as ``array<struct<name,arguments>>``; null when there is none.

    Accepts a list, a single call, or either as JSON text.
    """
    none = F.lit(None).cast(f"array<{schemas.TOOL_CALL}>")
    if value is None or data_type is None:
        return none
    if isinstance(data_type, T.StringType):
        parsed_type = T._parse_datatype_string(_JSON_CALLS)
        return tool_calls(F.from_json(value, _JSON_CALLS, WHOLE), parsed_type)
    if isinstance(data_type, T.StructType):
        return F.when(value.isNotNull(), F.array(_call(value, data_type)))
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
        calls = F.transform(value, lambda c: _call(c, data_type.elementType))
        return F.when(F.size(value) > 0, calls)
    return none


def truthy(value: Column | None, data_type: T.DataType | None) -> Column:
    """Truth of a value of any type: none, false, zero and empty values are false."""
    if value is None or isinstance(data_type, T.NullType):
        return F.lit(False)
    if isinstance(data_type, T.BooleanType):
        truth = value
    elif isinstance(data_type, T.NumericType):
        truth = value != 0
    elif isinstance(data_type, T.StringType):
        truth = value != ""
    elif isinstance(data_type, (T.ArrayType, T.MapType)):
        truth = F.size(value) > 0
    else:
        truth = value.isNotNull()
    return F.coalesce(truth, F.lit(False))


def normalize(messages: Column, data_type: T.ArrayType) -> Column:
    """Messages in the one layout of ``schemas.MESSAGE``; other keys are dropped."""
    fields = data_type.elementType

    def entry(message: Column) -> Column:
        def part(name: str) -> tuple[Column | None, T.DataType | None]:
            if name not in fields.names:
                return None, None
            return message.getField(name), fields[name].dataType

        flag = truthy(*part("train_on_turn"))
        return F.struct(
            message.getField("role").alias("role"),
            content_text(*part("content")).alias("content"),
            flag.alias("train_on_turn"),
            tool_calls(*part("tool_calls")).alias("tool_calls"),
        )

    return F.transform(messages, entry)


# The reasons for which a conversation is not valid.
NO_ROLE = " missing 'role'"
BAD_ROLE = " has unsupported role: "
NO_MESSAGES = "Missing 'messages' field"
NO_LIST = "'messages' must be a list"


def role_problem(role: Column, position: Column) -> Column:
    """Why a message at ``position`` is not acceptable, or null."""
    label = F.concat(F.lit("Message "), position.cast("string"))
    return F.when(role.isNull(), F.concat(label, F.lit(NO_ROLE))).when(
        ~role.isin(SUPPORTED_ROLES), F.concat(label, F.lit(BAD_ROLE), role)
    )


def messages_problem(messages: Column) -> Column:
    """First reason why a conversation is invalid, or null when it is valid."""
    problems = F.transform(messages, lambda m, i: role_problem(m.getField("role"), i))
    return F.when(messages.isNull(), F.lit(NO_MESSAGES)).otherwise(
        F.try_element_at(F.filter(problems, lambda p: p.isNotNull()), F.lit(1))
    )


def mark_replies(messages: Column) -> Column:
    """Make every model-written turn trainable; other turns keep their flag."""
    return F.transform(
        messages,
        lambda m: m.withField(
            "train_on_turn", is_reply(m.getField("role")) | m.getField("train_on_turn")
        ),
    )


def last_reply_index(messages: Column) -> Column:
    """0-based position of the last model-written message, null without one."""
    positions = F.transform(messages, lambda m, i: F.when(is_reply(m.getField("role")), i))
    return F.array_max(positions)


def history(messages: Column, until: Column) -> Column:
    """Messages before position ``until``."""
    return F.slice(messages, F.lit(1), until)
