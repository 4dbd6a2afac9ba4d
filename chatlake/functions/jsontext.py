"""Strict JSON parsing on top of ``from_json``.

``from_json`` accepts text after the value it reads. Here the text is put into
an array followed by an element with its own hash, and counts as valid only when
exactly that one value and the hash come back. A text cannot contain its own
hash, so it cannot pass for the end. Strings and numbers may have any length;
values nested over 1000 deep are not read.

The steps are columns of their own rather than one nested expression, so that
each text is trimmed and parsed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions.text import strip_json

_MARK = "__end_of_value"

# Options under which no value is too long.
WHOLE = {"maxStringLen": "2147483647", "maxNumLen": "2147483647"}
_OPTIONS = "map('allowSingleQuotes', 'false', " + ", ".join(f"'{k}', '{v}'" for k, v in WHOLE.items()) + ")"


def _with_values(df: DataFrame, texts: dict[str, Column], element: str, mark: str, default: str) -> DataFrame:
    """``mark`` reads the hash from the second element, ``default`` stands
    for a text that is not one object."""

    def digest(into: str) -> Column:
        body = f"`_{into}_text`"
        return F.expr(f"CASE WHEN startswith({body}, '{{') AND endswith({body}, '}}') THEN sha2({body}, 256) END")

    def values(into: str) -> Column:
        body, own = f"`_{into}_text`", f"`_{into}_hash`"
        return F.expr(
            f"""CASE WHEN {own} IS NOT NULL
                THEN from_json(concat('[', {body}, ',{{"{_MARK}":"', {own}, '"}}]'), 'array<{element}>', {_OPTIONS}) END"""
        )

    def single(into: str) -> Column:
        parsed = f"`_{into}_values`"
        return F.expr(
            f"""coalesce(CASE WHEN size({parsed}) = 2 AND {mark.format(f"try_element_at({parsed}, 2)")} = `_{into}_hash`
                         THEN try_element_at({parsed}, 1) END, {default})"""
        )

    return (
        df.withColumns({f"_{into}_text": strip_json(text) for into, text in texts.items()})
        .withColumns({f"_{into}_hash": digest(into) for into in texts})
        .withColumns({f"_{into}_values": values(into) for into in texts})
        .select(*df.columns, *[single(into).alias(into) for into in texts])
    )


def with_object(df: DataFrame, into: str, text: Column, fields: str) -> DataFrame:
    """Add ``into``: the JSON object in ``text`` as a struct with ``fields``
    (DDL ``name:type`` list), null for anything but exactly one object. Of a
    key that occurs again the last value counts."""
    return _with_values(df, {into: text}, f"struct<{fields},{_MARK}:string>", "{}." + _MARK, "NULL")


def with_maps(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """Add JSON objects as ``map<string,string>``, one per entry of ``texts``.

    Nested values stay compact JSON text and a JSON null is a null value.
    Anything but exactly one object gives an empty map. Of a key that occurs
    again the last value counts.
    """
    mark = "try_element_at({}, '" + _MARK + "')"
    read = _with_values(df, texts, "map<string,string>", mark, "CAST(map() AS map<string,string>)")
    return read.select(*df.columns, *[F.expr(_last_values(into)).alias(into) for into in texts])


def _last_values(name: str) -> str:
    keys = f"map_keys(`{name}`)"
    return f"""CASE WHEN size(array_distinct({keys})) < size({keys})
        THEN map_from_entries(filter(map_entries(`{name}`),
             (_entry, _at) -> array_position(reverse({keys}), _entry.key) = size({keys}) - _at))
        ELSE `{name}` END"""
