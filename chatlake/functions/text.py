"""Small string expressions: trimming, hashing, keys and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace a Unicode-aware strip removes. Java's Unicode
# \s leaves out the four ASCII separators 1C-1F.
UNICODE_SPACE = r"[\s\x1c-\x1f]"
JSON_SPACE = r"[ \t\r\n]"

# Fixed value: a parameter count inside a model name, such as 4b, 7.5B or 30M.
PARAMETER_COUNT = r"(?s)^(.*?)(\d+\.?\d*[bBmM].*)$"

SHORT_HASH_CHARS = 12


def strip(text: Column) -> Column:
    """Strip all Unicode whitespace, unlike ``trim`` which knows the blank only."""
    return F.regexp_replace(text, f"(?U)^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")


def strip_json(text: Column) -> Column:
    """Strip the four characters JSON itself allows around a value."""
    return F.trim(text, F.lit(" \t\r\n"))


def short_hash(text: Column) -> Column:
    """First 12 hex digits of the SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, SHORT_HASH_CHARS)


def composite_key(*parts: Column) -> Column:
    """Parts joined with underscores, as used for build and output folders."""
    return F.concat_ws("_", *parts)


def variant_name(model: Column, label: Column) -> Column:
    """Insert ``label`` before the first parameter count of a model name, or
    append it when the name has none."""
    head = F.regexp_replace(F.regexp_extract(model, PARAMETER_COUNT, 1), "[-_]+$", "")
    tail = F.regexp_extract(model, PARAMETER_COUNT, 2)
    return F.when(tail != "", F.concat(head, F.lit("-"), label, F.lit("-"), tail)).otherwise(
        F.concat(model, F.lit("-"), label)
    )


def percent(rate: Column) -> Column:
    """A rate of zero or more as a percentage with one decimal.

    Rounds the exact binary value, ties to even, as C and Python do; the JVM's
    own formatting rounds the shortest decimal instead, so 0.2995 differs.
    """
    x = rate * 100.0
    tenths = F.floor(x * 10.0)
    # x split into two halves of its digits, so that 20x minus the tie is exact
    wide = x * 134217729.0
    high = wide - (wide - x)
    side = (high * 20.0 - (tenths * 2 + 1).cast("double")) + (x - high) * 20.0
    rounded = tenths + F.when(side > 0, 1).when(side < 0, 0).otherwise(tenths % 2)
    return F.concat(
        F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"), F.lit("%")
    )
