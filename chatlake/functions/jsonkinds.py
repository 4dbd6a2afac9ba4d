"""What kind of JSON value a text came from, and message fields that depend on it.

A field read as a string loses its kind: 5 and "5" give the same text. Only a text that could
be the JSON of another value than a string is unclear, and only then the JSON around it is
read once more, as each other kind in turn; a value of another kind reads as null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatlake.functions.jsontext import WHOLE
from chatlake.functions.messages import NO_LIST, NO_MESSAGES, NO_ROLE, role_problem

_BLOCKS = "array<struct<type:string,text:string>>"
_OPTIONS = {**WHOLE, "allowNonNumericNumbers": "false"}
_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def unclear(text: Column) -> Column:
    """Whether a text could have been another JSON value than a string."""
    return F.coalesce(text.rlike(r"^(\[|\{|-?[0-9]|true$|false$)"), F.lit(False))


def maybe_text(raw: Column, field: str) -> Column:
    """Whether a line may hold ``field`` with a string somewhere; a key can be written with escapes."""
    return raw.rlike(rf'"{field}"\s*:\s*"') | F.contains(raw, F.lit("\\u"))


def _read(json: Column, field: str, kind: str) -> Column:
    return F.from_json(json, f"`{field}` {kind}", _OPTIONS).getField(field)


def kind(text: Column, json: Column, field: str) -> Column:
    """string, number, boolean, array or object: the kind of ``field`` in the object ``json``, which
    was read as ``text``. Null if there is no value."""
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(~unclear(text), F.lit("string"))
        .when(_read(json, field, "array<string>").isNotNull(), F.lit("array"))
        .when(_read(json, field, "map<string,string>").isNotNull(), F.lit("object"))
        .when(_read(json, field, "double").isNotNull(), F.lit("number"))
        .when(_read(json, field, "boolean").isNotNull(), F.lit("boolean"))
        .otherwise(F.lit("string"))
    )


def content(text: Column, message: Column) -> Column:
    """Plain text of a message whose ``content`` was read as ``text``: a string as it is, the first
    block of a list, and an empty text for everything else. ``message`` is the message's JSON."""
    first = F.try_element_at(F.from_json(text, _BLOCKS, WHOLE), F.lit(1)).getField("text")
    found = kind(text, message, "content")
    kept = F.when(~unclear(text), text).when(found == "array", first).when(found == "string", text)
    return F.coalesce(kept, F.lit(""))


def untrue_form(text: Column) -> Column:
    """Whether a text looks like a JSON value that does not count as true."""
    zero = text.rlike(_NUMBER) & (text.try_cast("double") == 0)
    return F.coalesce(text.isin("false", "[]", "{}") | zero, F.lit(False))


def truth(text: Column, message: Column, field: str) -> Column:
    """Truth of any JSON value that was read as ``text``: none, false, zero, an empty string, list or
    object are false. ``message`` is only needed where a string may look like one of these."""
    as_text = F.when(message.isNull(), F.lit(False)).otherwise(kind(text, message, field) == "string")
    return F.when(text.isNull() | (text == ""), F.lit(False)).when(~untrue_form(text), F.lit(True)).otherwise(as_text)


def has_key(raw: Column, field: str) -> Column:
    return F.coalesce(F.map_contains_key(F.from_json(raw, "map<string,string>", WHOLE), field), F.lit(False))


def list_problem(raw: Column) -> Column:
    """Why the ``messages`` of the object ``raw`` are not a list of objects: absent, not a list, or the
    first element that is no acceptable message, with its position."""
    texts = _read(raw, "messages", "array<string>")
    # kinds are exact where the line has no repeated keys
    kinds = F.transform(F.try_variant_get(F.try_parse_json(raw), "$.messages", "array<variant>"), lambda v: F.schema_of_variant(v))

    def problem(text: Column, at: Column) -> Column:
        known = F.try_element_at(kinds, at + 1)
        looks = F.startswith(text, F.lit("{")) & F.from_json(text, "map<string,string>", WHOLE).isNotNull()
        is_object = F.when(known.isNotNull(), F.startswith(known, F.lit("OBJECT"))).otherwise(F.coalesce(looks, F.lit(False)))
        missing = F.concat(F.lit("Message "), at.cast("string"), F.lit(NO_ROLE))
        return F.when(~is_object, missing).otherwise(role_problem(_read(text, "role", "string"), at))

    first = F.try_element_at(F.filter(F.transform(texts, problem), lambda p: p.isNotNull()), F.lit(1))
    absent = F.when(has_key(raw, "messages"), F.lit(NO_LIST)).otherwise(F.lit(NO_MESSAGES))
    return F.when(texts.isNull(), absent).otherwise(first)
