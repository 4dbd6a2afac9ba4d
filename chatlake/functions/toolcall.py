"""Tool calls in model replies: finding, comparing and scoring them.

Everything is built-in expressions, so scoring stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake import schemas
from chatlake.functions.jsontext import with_maps, with_object
from chatlake.functions.text import UNICODE_SPACE, strip

# The tags around a call in a reply.
CALL_OPEN = "<tool_call>"
CALL_CLOSE = "</tool_call>"
CALL_PATTERN = f"(?sU){CALL_OPEN}{UNICODE_SPACE}*(\\{{.*?\\}}){UNICODE_SPACE}*{CALL_CLOSE}"

_CALL_FIELDS = "name:string,arguments:string"


def _as_call(parsed: str, present: str) -> str:
    return f"""CASE WHEN {present} IS NOT NULL THEN CAST(named_struct(
        'name', coalesce({parsed}.name, ''), 'arguments', coalesce({parsed}.arguments, '{{}}'))
        AS {schemas.TOOL_CALL}) END"""


def with_tool_call(df: DataFrame, text: str = "predicted_text", into: str = "predicted_tool") -> DataFrame:
    """Add the tool call in a reply as ``struct<name,arguments>``, or null.

    The first tagged JSON object wins. When there is none, or it is not valid
    JSON, the whole stripped reply must be a JSON object with a name.
    """
    in_tag = df.withColumn("_in_tag", F.regexp_extract(text, CALL_PATTERN, 1))
    first = with_object(in_tag, "_tagged", F.col("_in_tag"), _CALL_FIELDS)
    rest = F.when(F.isnull("_tagged"), strip(F.col(text)))
    call = F.expr(f"coalesce({_as_call('_tagged', '_tagged')}, {_as_call('_whole', '_whole.name')})")
    return with_object(first, "_whole", rest, _CALL_FIELDS).select(*df.columns, call.alias(into))


def with_arguments(df: DataFrame, arguments: dict[str, Column]) -> DataFrame:
    """Add call arguments as ``map<string,string>``, one column per entry;
    anything but a JSON object is an empty map."""
    return with_maps(df, arguments)


def arguments_match(predicted: str, expected: str) -> Column:
    """Every expected argument equals the predicted one as lower-cased text.

    Both are map columns. Extra predicted keys do not matter; a missing key
    counts as an empty text and a JSON null as ``none``.
    """
    return F.expr(
        f"""forall(map_entries({expected}), e ->
              lower(CASE WHEN map_contains_key({predicted}, e.key)
                    THEN coalesce(try_element_at({predicted}, e.key), 'none') ELSE '' END)
              = lower(coalesce(e.value, 'none')))"""
    )


def name_match(predicted: str, expected: str) -> Column:
    """Same tool name regardless of case, or no tool on either side."""
    return F.expr(
        f"""CASE WHEN {predicted} IS NULL OR {expected} IS NULL THEN {predicted} IS NULL AND {expected} IS NULL
            ELSE lower({predicted}.name) = lower(coalesce({expected}.name, '')) END"""
    )


def false_positive(predicted: str, expected: str) -> Column:
    return F.expr(f"{predicted} IS NOT NULL AND {expected} IS NULL")


def false_negative(predicted: str, expected: str) -> Column:
    return F.expr(f"{predicted} IS NULL AND {expected} IS NOT NULL")


def call_json(call: Column) -> Column:
    """A ``struct<name,arguments>`` as the JSON object written into a turn."""
    head = F.to_json(F.struct(call.getField("name").alias("name")))
    arguments = call.getField("arguments")
    quoted = F.to_json(F.struct(arguments.alias("arguments")))
    tail = F.when(
        F.startswith(F.ltrim(arguments), F.lit("{")),
        F.concat(F.lit('"arguments":'), arguments, F.lit("}")),
    ).otherwise(F.substr(quoted, F.lit(2)))
    return F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(","), tail)


def render_call(call: Column) -> Column:
    """A tool call in the tag form that ``parse_tool_call`` reads."""
    return F.concat(F.lit(CALL_OPEN + "\n"), call_json(call), F.lit("\n" + CALL_CLOSE))
